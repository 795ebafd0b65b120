"""Connected components of an edge table by alternating star contraction.

Every round is joins and minima on columns of two longs; no neighbourhood is gathered
into one row, and nothing but a count and a checksum reaches the driver. A hub with many
neighbours is one hot key of a join whose other side has one row per vertex, so adaptive
execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import written


def _hook(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each vertex's neighbours (only those above it, or only those below it and itself)
    hooked to the least vertex around it."""
    if larger_only:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    met = around.join(least, around["a"] == least["u"])
    if larger_only:
        hooked = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"),
                                                           F.col("m").alias("b"))
    else:
        hooked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hooked.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every vertex of ``edges`` (longs ``a``, ``b``) but the roots
    themselves; a root is the least vertex of its component. Loops and repeated edges are
    allowed; an empty table gives an empty one."""
    current = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        row = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or row[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(row)
        current = written(_hook(_hook(current, True), False), "edges")
