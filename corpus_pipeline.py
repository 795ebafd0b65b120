"""A training corpus from ``documents``, stage by stage.

Each stage takes what its predecessor kept; its frame is written as Parquet and read
again as the documents of the next one. All stages but the last return the columns of
the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimgauge.llm import decontamination, mixing, near_copies, sharding, toxicity
from claimgauge.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, 0.8) stays; they are found by the
    Gray-order SimHash index, with MinHash for what it leaves apart."""
    return near_copies.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, re-parameterised or not, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says: never, once, sometimes twice."""
    return mixing.mixed(docs, mixing.domain_labels(table(spark, sf_dir, "labels")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their size, shard and slot."""
    return sharding.histogram_shards(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("decontamination", decontaminate),
          ("mixing", mix), ("sharding", shard)]

#: SQL cannot express the models and hashes of the stages; tests/llm holds the run against
#: plain Python versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages. Null ids and texts, repeated rows and an empty table pass
    as the docstrings of the operators say; extra columns are carried along."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
