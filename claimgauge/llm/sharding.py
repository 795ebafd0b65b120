"""Shards of equal bytes by a histogram sort.

The rows are ordered by a 64-bit key. Probe keys are counted exactly (rows and bytes
below each, over all partitions) in one pass over a slim written table of keys and
sizes; the interval around each wanted splitter is then probed again, finer, until the
splitter meets the tolerance. Then the rows are exchanged once, straight to the range
that holds them, and numbered there: the counts below a range are already known.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgauge.llm.common import written

SHARDS = 16
TOLERANCE = 0.01
PROBES = 256
RANGE_BYTES = 64 << 20
#: Keys of equal texts differ in the lower 32 bits only.
GROUP_BITS = 32


def text_key(docs: DataFrame) -> Column:
    """Upper half from the text, lower half from the id: equal texts lie together, and a
    group larger than a shard can still be cut between ids."""
    upper = F.xxhash64(F.col("text")).bitwiseAND(F.lit(-1 << GROUP_BITS))
    return upper.bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 64 - GROUP_BITS))


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; 1 for null."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + 1


@dataclass
class Histogram:
    """Exact counts below the keys probed so far, in key order. The first entry is the
    least key with nothing below it, the last lies above all keys."""

    keys: list[int]
    rows: list[int]
    bytes: list[int]

    def add(self, probes: list[int], rows: np.ndarray, sizes: np.ndarray) -> None:
        known = dict(zip(self.keys, zip(self.rows, self.bytes)))
        known.update(zip(probes, zip(np.cumsum(rows).tolist(), np.cumsum(sizes).tolist())))
        self.keys = sorted(known)
        self.rows, self.bytes = ([known[k][i] for k in self.keys] for i in (0, 1))


def _searched(column: Column, keys: list[int], *columns: np.ndarray) -> Column:
    """Index of the last of ``keys`` at or below the value (the first has none below it),
    or a struct of the ``columns`` at that index."""
    bounds = np.array(keys, np.int64)
    if not columns:
        @F.pandas_udf("int")
        def index(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, values.to_numpy(), "right").astype("int32"))
        return index(column)

    @F.pandas_udf("range int, shard int, base long")
    def found(values: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, values.to_numpy(), "right") - 1
        return pd.DataFrame({"range": at.astype("int32"), "shard": columns[0][at],
                             "base": columns[1][at]})
    return found(column)


def _count(slim: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bytes between consecutive probes; one row per probe comes to the driver."""
    counted = slim.groupBy(_searched(F.col("key"), probes).alias("at")).agg(
        F.count("*").alias("n"), F.sum("size").alias("b")).toPandas()
    rows, sizes = (np.zeros(len(probes) + 1, np.int64) for _ in range(2))
    rows[counted["at"]], sizes[counted["at"]] = counted["n"], counted["b"]
    return rows[:-1], sizes[:-1]


def _inside(low: int, high: int, probes: int) -> list[int]:
    """Keys strictly between two, evenly; between groups as long as there are groups."""
    unit = 1 << GROUP_BITS
    first, last = -(-(low + 1) // unit), (high - 1) // unit
    if last < first:
        unit, first, last = 1, low + 1, high - 1
    span = last - first + 1
    count = min(probes, span)
    return [(first + span * k // count + (span // count) // 2) * unit for k in range(count)]


def splitters(slim: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
              probes: int = PROBES, range_bytes: int = RANGE_BYTES) -> tuple[Histogram, list[int]]:
    """Counts of all probes, and the key each shard but the first begins with.

    A splitter is settled once a probed key is within ``tolerance`` of a shard's bytes of
    its target, or a single row or key is left between the nearest two. Ranges of more
    than twice ``range_bytes`` are probed further as well. The driver holds one entry per
    probe: a few thousand, or four for each ``range_bytes`` of input.
    """
    low, high, rows, total = slim.agg(F.min("key"), F.max("key"), F.count("*"),
                                      F.coalesce(F.sum("size"), F.lit(0))).first()
    if not rows:
        return Histogram([0], [0], [0]), [0] * (shards - 1)
    known = Histogram([low, high + 1], [0, rows], [0, total])
    each = max(probes, 4 * total // (range_bytes * shards))
    wanted = _inside(low, high + 1, each * shards)
    while wanted:
        known.add(wanted, *_count(slim, wanted))
        below, wanted = np.array(known.bytes), []
        for k in range(1, shards):
            target = total * k / shards
            at = min(max(int(np.searchsorted(below, target)), 1), len(below) - 1)
            off = min(abs(below[at] - target), abs(below[at - 1] - target))
            if off > tolerance * total / shards and known.rows[at] - known.rows[at - 1] > 1:
                wanted += _inside(known.keys[at - 1], known.keys[at], probes)
        for at in np.flatnonzero(np.diff(below) > 2 * range_bytes):
            wanted += _inside(known.keys[at], known.keys[at + 1], 8)
        wanted = sorted(set(wanted) - set(known.keys))
    keys = []
    for k in range(1, shards):
        off = np.abs(np.array(known.bytes) - total * k / shards)
        near = np.flatnonzero(off <= max(off.min(), tolerance * total / shards))
        best = min(near, key=lambda i: (known.keys[i] % (1 << GROUP_BITS) != 0, off[i]))
        keys.append(min(max(known.keys[best], keys[-1] if keys else low), (1 << 63) - 1))
    return known, keys


def _heavy_keys(slim: DataFrame, share: float) -> list[int]:
    """Keys of several rows that hold more than this share of all bytes: fewer than its
    inverse."""
    total = slim.agg(F.sum("size")).first()[0] or 0
    held = slim.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    return [r["key"] for r in held.where((F.col("n") > 1) & (F.col("b") > share * total)).collect()]


def histogram_shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
                     probes: int = PROBES, range_bytes: int = RANGE_BYTES,
                     key: Column | None = None) -> DataFrame:
    """``docs`` with ``size`` (bytes), ``shard`` (0 to ``shards`` - 1) and ``slot``
    (gapless from 0 in each shard); columns of these names are replaced.

    Shard sizes differ from the mean by about twice the tolerance at most, or by a row
    where rows are larger than that. Equal texts share a shard unless the group is cut by
    a splitter that cannot move by its size. Rows alike in text and id have one key; where
    they are more than the tolerance, they are written with keys of their own and can be
    cut as well (not with a ``key`` of the caller's, whose order is kept).
    Null texts count as size 1 and form a group of their own. An empty table stays empty.
    ``key`` may be any long expression without nulls.
    """
    own, key = key is None, text_key(docs) if key is None else key
    keyed = docs.withColumn("__key", key)
    slim = written(keyed.select(F.col("__key").alias("key"), byte_size(F.col("text")).alias("size")), "keys")
    alike = _heavy_keys(slim, tolerance / shards) if own else []
    if alike:
        # a row's number is settled by writing the row, and only these rows
        number = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - GROUP_BITS)
        upper = F.col("__key").bitwiseAND(F.lit(-1 << GROUP_BITS))
        cut = written(keyed.where(F.col("__key").isin(alike)).withColumn("__key", upper.bitwiseOR(number)), "alike")
        keyed = keyed.where(~F.col("__key").isin(alike)).unionByName(cut)
        slim = written(keyed.select(F.col("__key").alias("key"), byte_size(F.col("text")).alias("size")), "keys")
    known, starts = splitters(slim, shards, tolerance, probes, range_bytes)
    cuts, ranges, base = set(starts), [], []
    for k, b, below in zip(known.keys[:-1] or known.keys, known.bytes, known.rows):
        if not ranges or k in cuts or b - since >= range_bytes:
            ranges.append(k)
            base.append(below)
            since = b
    shard = np.searchsorted(np.array(starts), np.array(ranges), "right").astype("int32")
    first = {s: n for s, n in reversed(list(zip(shard.tolist(), base)))}
    base = np.array([n - first[s] for s, n in zip(shard.tolist(), base)], np.int64)
    placed = keyed.withColumn("size", byte_size(F.col("text")))
    placed = placed.withColumn("__place", _searched(F.col("__key"), ranges, shard, base))
    order = Window.partitionBy("__range").orderBy("__key", "doc_id", F.xxhash64("text"))
    return (placed.withColumns({"__range": F.col("__place.range"), "shard": F.col("__place.shard"),
                                "__base": F.col("__place.base")}).drop("__place")
            .withColumn("slot", F.row_number().over(order) + F.col("__base") - 1)
            .drop("__key", "__range", "__base"))
