"""What the corpus operators share: tables, written intermediates, fold rules, row keys.

Row identity. ``doc_id`` may be null or repeated, so rows are joined back on
``ROW_KEY``: the id and the XXH64 of the text. Rows alike in both are copies of one
another and always get the same answer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.session import scratch_dir

#: Words of all contracts: runs of anything but these six white-space characters.
WHITE = " \t\n\x0b\f\r"

ROW_KEY = ["__id", "__text_hash"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as Parquet in the shared folder, read again: its lineage ends there, so a
    lost executor costs no more than the tasks it ran."""
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def with_row_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """``docs`` plus the two columns of ``ROW_KEY``."""
    return docs.withColumns({"__id": F.col(id_column).cast("bigint"),
                             "__text_hash": F.xxhash64(F.col(text_column))})


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on ``ROW_KEY`` that lets null ids meet (XXH64 is never null)."""
    return (left["__id"].eqNullSafe(right["__id"])
            & (left["__text_hash"] == right["__text_hash"]))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the row is kept from learning; a row without id is not of the held-out
    fold, but is not learned from either (see ``may_learn``)."""
    return F.coalesce(fold_of(doc_id, folds) == fold, F.lit(False))


def may_learn(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(fold_of(doc_id, folds) != fold, F.lit(False))


def words_of(text: Column) -> Column:
    """Array of the words of a text, empty for null or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), "")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once per row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def labelled_sample(docs: DataFrame, labelled: DataFrame, classes: list, rows: int,
                    seed: int = 17) -> DataFrame:
    """At most ``rows`` labelled texts, an equal share of each of ``classes``: columns
    ``text``, ``label`` and ``weight``, how many labelled texts of its label a text stands for.

    ``labelled`` has ``doc_id`` and ``label``. The texts are those of smallest seeded hash of
    their ids, so the sample does not depend on partitioning. Ids labelled twice count
    once, with the larger label; null labels, ids and texts are not learned from.
    """
    known = (labelled.where(F.col("label").isin(classes) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("__id")).agg(F.max("label").alias("label"))
             .withColumn("__order", F.xxhash64("__id", F.lit(seed))))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("__id"), "text").where(
        F.col("text").isNotNull())
    present = written(known.join(texts.select("__id"), "__id", "left_semi"), "labelled")
    counts = {r["label"]: r["count"] for r in present.groupBy("label").count().collect()}
    share = rows // len(classes)
    chosen = [present.where(F.col("label") == x).orderBy("__order", "__id").limit(share)
              .select("__id", "label", F.lit(max(1.0, counts.get(x, 0) / share)).alias("weight"))
              for x in classes]
    # At most ``rows`` ids of some 20 bytes: bounded by the parameter, so it may be broadcast.
    picked = F.broadcast(reduce(DataFrame.unionByName, chosen))
    return (texts.join(picked, "__id").groupBy("__id", "label", "weight")
            .agg(F.min("text").alias("text")))


def fold_labels(labels: DataFrame, target: str, folds: int, fold: int) -> DataFrame:
    """``doc_id`` and 0/1 ``label`` of the rows that may be learned from."""
    return labels.where(may_learn(F.col("doc_id"), folds, fold)).select(
        "doc_id", F.col(target).cast("int").alias("label"))
