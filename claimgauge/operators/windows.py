"""Time windows anchored at the latest submission of a run, and joins to them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.operators.joins import fits
from claimgauge.operators.spine import Spine

LOOKBACK_DAYS = 2
FALLBACK_MINUTES = 20


def _back(end: Column, **interval: int) -> Column:
    return end - F.make_dt_interval(**{k: F.lit(v) for k, v in interval.items()})


def anchored_window(submitted: DataFrame, run_id: str, as_of: Column,
                    lookback_days: int = LOOKBACK_DAYS,
                    fallback_minutes: int = FALLBACK_MINUTES,
                    run: str = "submission_run_id", ingested: str = "ingested_at") -> DataFrame:
    """The window of one run, as one row ``lo``, ``hi``.

    It ends at the latest ingestion of the run's submitted rows, or some minutes
    before the event when there are none, and is closed on both ends.
    """
    last = submitted.where(F.col(run) == F.lit(run_id)).agg(F.max(ingested).alias("_last"))
    end = F.coalesce("_last", _back(as_of, mins=fallback_minutes))
    return last.select(_back(end, days=lookback_days).alias("lo"), end.alias("hi"))


def anchored_windows(runs: DataFrame, submitted: DataFrame, keys: Sequence[str],
                     lookback_days: int = LOOKBACK_DAYS,
                     fallback_minutes: int = FALLBACK_MINUTES,
                     ingested: str = "ingested_at") -> DataFrame:
    """:func:`anchored_window` of every run.

    ``keys`` are the columns, shared with ``submitted``, that name a run. Rows of other runs
    are dropped first where the runs fit a broadcast. The maximum is combined before the
    shuffle, so a run with most of the rows is no hot spot.
    """
    wanted = runs.select(*keys).distinct()
    if fits(wanted):
        submitted = submitted.join(F.broadcast(wanted), list(keys), "left_semi")
    last = submitted.groupBy(*keys).agg(F.max(ingested).alias("_last"))
    end = F.coalesce("_last", _back(F.col("as_of"), mins=fallback_minutes))
    return runs.join(last, list(keys), "left").select(
        *runs.columns, _back(end, days=lookback_days).alias("lo"), end.alias("hi"))


def _bucket(ts: Column, width_days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(ts)) / F.lit(width_days)).cast("int")


@dataclass(frozen=True)
class Windows:
    """Closed time windows ``[lo, hi]``, of one run or of each run of a spine."""

    spine: Spine | None
    first: Column
    last: Column
    width_days: int

    @classmethod
    def single(cls, window: DataFrame, width_days: int = LOOKBACK_DAYS) -> Windows:
        """One run. Its window, one row, is read now and becomes two constants."""
        types = dict(window.dtypes)
        found = window.select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
        return cls(None, F.lit(found["lo"]).cast(types["lo"]),
                   F.lit(found["hi"]).cast(types["hi"]), width_days)

    @classmethod
    def of(cls, windows: DataFrame, keys: Sequence[str], lookup: Sequence[str],
           width_days: int = LOOKBACK_DAYS) -> Windows:
        """The windows of many runs, with their ``keys`` and the ``lookup`` columns
        that name the tables a run reads."""
        spine = Spine.of(windows, keys, lookup, "lo", "hi")
        return cls(spine, spine.first, spine.last, width_days)

    @property
    def keys(self) -> tuple[str, ...]:
        return self.spine.keys if self.spine else ()

    @property
    def lookup(self) -> tuple[str, ...]:
        return self.spine.lookup if self.spine else ()

    def runs(self, like: DataFrame) -> DataFrame:
        """The run keys; for a single run one row without columns."""
        return self.spine.index if self.spine else like.sparkSession.range(1).select()

    def of_rows(self, rows: DataFrame, ts: str = "ingested_at") -> DataFrame:
        """Rows whose ``ts`` lies in the window of a run, once per such run.

        The outer bounds are constants the scan prunes by; for a single run they are
        the whole answer. For many runs, windows are cut into buckets of their own
        width: a row meets only the runs close to it, in an equi-join.
        """
        rows = rows.where(F.col(ts).between(self.first, self.last))
        if self.spine is None:
            return rows
        runs = self.spine.runs
        cut = runs.withColumn("_bucket", F.explode(F.sequence(
            _bucket(F.col("lo"), self.width_days), _bucket(F.col("hi"), self.width_days))))
        if self.spine.small:
            cut = F.broadcast(cut)
        return (
            rows.withColumn("_bucket", _bucket(F.col(ts), self.width_days))
            .join(cut, [*self.lookup, "_bucket"])
            .where(F.col(ts).between(F.col("lo"), F.col("hi")))
            .drop("_bucket", "lo", "hi")
        )
