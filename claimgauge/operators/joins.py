"""Join shapes the metrics share: hot-key-proof semi joins and per-run lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pieces a hot join key is cut into. The other side is copied as often, so this is for
# joins whose other side is a small part of the data.
SALTS = 8


# Bytes up to which keys or links are broadcast.
BROADCAST_BYTES = 20 << 20


def row_bytes(*columns: str) -> Column:
    """About what a row of these columns takes in a broadcast."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in columns]
    return reduce(lambda a, b: a + b, sizes, F.lit(16).cast("long"))


def fits(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of ``frame`` take at most ``limit`` bytes: a plain sum, one partial
    row per task. It runs what the frame is made of, so ask once and share the answer."""
    size = frame.agg(F.sum(row_bytes(*frame.columns))).first()[0]
    return (size or 0) <= limit


def salted(frame: DataFrame, spread: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Give each row one of ``salts`` numbers, by columns that vary within a hot key."""
    return frame.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def salt_copies(frame: DataFrame, salts: int = SALTS) -> DataFrame:
    """The other side of a salted join: every row under every salt."""
    return frame.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _salted_filter(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str],
                   how: str) -> DataFrame:
    copies = salt_copies(right.select(*on))
    return salted(left, spread).join(copies, [*on, "_salt"], how).drop("_salt")


def salted_semi(left: DataFrame, right: DataFrame, on: Sequence[str],
                spread: Sequence[str]) -> DataFrame:
    """Left semi join in which the rows of one ``on`` key go to many tasks.

    ``right`` holds distinct keys. NULL keys match nothing and are spread as well.
    """
    return _salted_filter(left, right, on, spread, "left_semi")


def salted_anti(left: DataFrame, right: DataFrame, on: Sequence[str],
                spread: Sequence[str]) -> DataFrame:
    """Left anti counterpart of :func:`salted_semi`; rows with NULL keys stay."""
    return _salted_filter(left, right, on, spread, "left_anti")


def linked(rows: DataFrame, links: DataFrame, on: Sequence[str], small: bool,
           how: str = "inner") -> DataFrame:
    """``rows`` joined to ``links``: broadcast if ``small``, else with the rows of each key
    spread over several tasks by their other columns."""
    if small:
        return rows.join(F.broadcast(links), list(on), how)
    spread = [c for c in rows.columns if c not in on] or list(on)
    return salted(rows, spread).join(salt_copies(links), [*on, "_salt"], how).drop("_salt")


def attach(frame: DataFrame, values: DataFrame, keys: Sequence[str],
           columns: Sequence[str]) -> DataFrame:
    """Add per-run ``columns`` of ``values`` to the rows of a run.

    Without keys ``values`` is one row, read as a scalar subquery: no cross join.
    """
    if keys:
        return frame.join(values.select(*keys, *columns), list(keys), "left")
    one = values.select(F.struct(*columns)).scalar()
    return (frame.withColumn("_one", one)
            .select(*frame.columns, *[F.col("_one")[c].alias(c) for c in columns]))
