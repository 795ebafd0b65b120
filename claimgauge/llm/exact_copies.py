"""Exact copies by a tree merge of sorted digest runs.

Texts are equal if they are identical without white space. Each partition of the input
makes a run: its digests in order, each with the best row that has it. Runs are then
exchanged in binomial rounds: in a step, node n with the bit of the step set hands its
run to the node without it. An exchange takes ``STEPS`` steps at once, so that a merge
joins up to 16 runs. At every level entries meet only if the full SHA-256 agrees besides
the 64-bit digest they are sorted by, and the best row of those that meet is retained.
A run lies dealt by digest over the tasks, so no task holds a whole one; of a digest that
every partition has, a task is given 16 entries a level, not one per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import WHITE, written

#: Binomial steps of one exchange.
STEPS = 4
#: A group counts as hot if it holds more than one in so many rows; so there are fewer hot
#: groups than this, which bounds what is broadcast to some 100 KB.
HOT = 1_000


def without_white(text: Column) -> Column:
    """The text without its white space; empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _entries(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A slim row per document; ``leaf`` and ``row`` are settled by writing them."""
    text = F.col(text_column)
    bare = without_white(text)
    return written(docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.char_length(text), F.lit(0)).alias("points"),
        F.xxhash64(text).alias("text_hash"), F.xxhash64(bare).alias("digest"),
        F.unhex(F.sha2(bare.cast("binary"), 256)).alias("sha"),
        F.spark_partition_id().alias("leaf"), F.monotonically_increasing_id().alias("row")), "digests")


def merged_runs(entries: DataFrame, steps: int = STEPS) -> DataFrame:
    """``digest``, ``sha``, ``best`` (struct of the row that stays) and ``size`` of each group."""
    best = F.struct((-F.col("points")).alias("shorter"), F.col("id").isNull().alias("nameless"),
                    "id", "row")
    runs = entries.select(F.col("leaf").alias("node"), "digest", "sha", best.alias("best"),
                          F.lit(1).cast("long").alias("size"))
    left = entries.agg(F.max("leaf")).first()[0] or 0
    while True:
        runs = runs.withColumn("node", F.shiftright("node", steps)).groupBy(
            "node", "digest", "sha").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        left >>= steps
        if not left:
            return runs.drop("node")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 steps: int = STEPS, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``text_hash`` (XXH64 of the text as it is),
    ``keep_id`` (id of the row that stays), ``group_size``, ``kept`` and ``text_sha256``
    (hex, of the text without white space).

    Of equal texts the one of most code points stays, then the one of the smallest id;
    null ids come last, and of rows alike in both any one stays. Null texts count as
    empty, and all empty or blank texts form one group. An empty table gives an empty
    one. Other columns of ``docs``, whatever their names, are not looked at.
    """
    entries = _entries(docs, id_column, text_column)
    groups = written(merged_runs(entries, steps), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    key = ["digest", "sha"]
    single = groups.where(F.col("size") == 1)
    many = groups.where(F.col("size") > 1).select(
        *key, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"),
        F.col("size").alias("group_size"))
    is_hot = F.col("group_size") * hot > total
    hottest = F.broadcast(many.where(is_hot))
    met = entries.join(hottest, key).unionByName(
        entries.join(hottest.select(*key), key, "left_anti").join(many.where(~is_hot), key))
    alone = entries.join(single.select(F.col("best.row").alias("row")), "row", "left_semi")
    found = met.withColumn("kept", F.col("row") == F.col("keep_row")).unionByName(
        alone.withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"),
                           "kept": F.lit(True)}), allowMissingColumns=True)
    return found.select("id", "text_hash", "keep_id", "group_size", "kept",
                        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as they are."""
    kept = exact_groups(docs, id_column, text_column).where("kept").select(
        F.col("id").alias("__kept_id"), F.col("text_hash").alias("__kept_hash"))
    marked = docs.withColumn("__own_hash", F.xxhash64(F.col(text_column)))
    there = (F.col(id_column).eqNullSafe(F.col("__kept_id"))
             & (F.col("__own_hash") == F.col("__kept_hash")))
    return marked.join(kept, there, "left_semi").dropDuplicates(
        [id_column, "__own_hash"]).select(*docs.columns)
