"""Value shares of filtered, processable and excluded rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.expressions import or_zero, ratio
from claimgauge.operators.spine import over_runs


class MissingTableError(ValueError):
    """A table without a fallback is missing."""


def share_columns(part: Column, rest: Column, denominator: str, emit: str,
                  rest_present: Column | None = None) -> list[Column]:
    """``total`` and ``relative`` from the two sums of a run.

    ``denominator``: ``sum`` divides by part + rest, ``rest`` by rest alone.
    ``emit``: when ``relative`` is a point at all (else NULL): ``always``,
    ``if_positive`` (part + rest > 0) or ``if_rest_present``.
    """
    if denominator not in ("sum", "rest"):
        raise ValueError(f"unknown denominator {denominator}")
    part, rest = or_zero(part), or_zero(rest)
    whole = part + rest if denominator == "sum" else rest
    relative = F.when(whole > 0, ratio(part, whole)).otherwise(F.lit(0.0))
    if emit == "if_positive":
        relative = F.when(part + rest > 0, relative)
    elif emit == "if_rest_present":
        relative = relative if rest_present is None else F.when(rest_present, relative)
    elif emit != "always":
        raise ValueError(f"unknown emit rule {emit}")
    return [part.alias("total"), relative.alias("relative")]


def value_share(rows: DataFrame, value: str, is_part: Column, is_rest: Column,
                keys: Sequence[str] = (), spine: DataFrame | None = None,
                denominator: str = "sum", emit: str = "always",
                rest_present: Column | None = None) -> DataFrame:
    """Share of the ``is_part`` rows in one pass over ``rows``.

    Sums are combined before the shuffle, so a hot run costs one row per task.
    With a ``spine`` every run of it has a row, also one without any rows.
    """
    sums = rows.groupBy(*keys).agg(
        F.sum(F.when(is_part, F.col(value))).alias("_part"),
        F.sum(F.when(is_rest, F.col(value))).alias("_rest"),
    )
    return over_runs(spine, sums, keys).select(
        *keys, *share_columns(F.col("_part"), F.col("_rest"), denominator, emit, rest_present)
    )


def filtered_share(part: DataFrame | None, rest: DataFrame | None, value: str,
                   keys: Sequence[str] = (), spine: DataFrame | None = None,
                   denominator: str = "sum", emit: str = "always",
                   rest_present: Column | None = None) -> DataFrame:
    """:func:`value_share` over two tables, either of which may be missing (``None``).

    A missing part counts 0; so does a missing rest, unless the rest alone is the
    denominator, which is an error.
    """
    if rest is None and denominator == "rest":
        raise MissingTableError("the denominator table is missing")
    sides = [frame.select(*keys, F.col(value).alias("_value"), F.lit(side).alias("_side"))
             for side, frame in (("part", part), ("rest", rest)) if frame is not None]
    if not sides:
        raise MissingTableError("no table to read; use no_tables_share")
    rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    if rest is None:
        rest_present = F.lit(False)
    return value_share(rows, "_value", F.col("_side") == "part", F.col("_side") == "rest",
                       keys, spine, denominator, emit, rest_present)


def no_tables_share(spine: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The share when both tables are missing: total 0 and no relative point."""
    return spine.select(*keys, F.lit(0.0).alias("total"),
                        F.lit(None).cast("double").alias("relative"))
