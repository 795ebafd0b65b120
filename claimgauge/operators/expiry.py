"""Saving lost to expired validations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.expressions import or_zero
from claimgauge.operators.joins import linked
from claimgauge.operators.spine import over_runs
from claimgauge.operators.windows import Windows
from claimgauge.schemas import EXPIRED
from claimgauge.session import require_utc

INGESTED_DAYS = 2
UPDATED_MINUTES = 30


def _updated_just_before(as_of: Column, minutes: int) -> Column:
    end = as_of.cast("timestamp_ntz")
    return F.col("updated_at").between(end - F.make_dt_interval(mins=F.lit(minutes)), end)


def expired_validation_total(validation: DataFrame, as_of: Column, days: int = INGESTED_DAYS,
                             minutes: int = UPDATED_MINUTES) -> DataFrame:
    """One run: saving of rows ingested in the last days that expired just now.

    The ingestion bounds are constants the scan can prune by; the update time is
    zone-less and filters rows.
    """
    require_utc(validation.sparkSession)
    start = as_of - F.make_dt_interval(days=F.lit(days))
    return (
        validation.where(F.col("ingested_at").between(start, as_of))
        .where(_updated_just_before(as_of, minutes))
        .where(F.col("status") == EXPIRED)
        .agg(or_zero(F.sum("saving_value")).alias("expired_saving"))
    )


def expired_validation_total_by_run(runs: DataFrame, validation: DataFrame,
                                    keys: Sequence[str], lookup: Sequence[str],
                                    days: int = INGESTED_DAYS,
                                    minutes: int = UPDATED_MINUTES) -> DataFrame:
    """:func:`expired_validation_total` of every run; ``lookup`` names its tables.

    Rows meet runs by half hours of their update time, the narrower of the two ranges; the
    outermost ingestion times are constants the scan can prune by.
    """
    start = F.col("as_of") - F.make_dt_interval(days=F.lit(days))
    windows = Windows.of(
        runs.select(*dict.fromkeys([*keys, *lookup, "as_of"]), start.alias("lo"),
                    F.col("as_of").alias("hi")), keys, lookup, days)

    def bucket(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(60 * minutes))

    end = F.col("as_of")
    links = windows.spine.runs.withColumn("_bucket", F.explode(F.sequence(
        bucket(end - F.make_dt_interval(mins=F.lit(minutes))), bucket(end))))
    expired = validation.where(F.col("status") == EXPIRED).where(
        F.col("ingested_at").between(windows.first, windows.last)).select(
        *lookup, "saving_value", "ingested_at", "updated_at", bucket(F.col("updated_at")).alias("_bucket"))
    sums = (
        linked(expired, links, [*lookup, "_bucket"], windows.spine.small)
        .where(F.col("ingested_at").between(F.col("lo"), F.col("hi")))
        .where(_updated_just_before(F.col("as_of"), minutes))
        .groupBy(*keys).agg(F.sum("saving_value").alias("_sum"))
    )
    return over_runs(windows.runs(validation), sums, keys).select(
        *keys, or_zero(F.col("_sum")).alias("expired_saving"))
