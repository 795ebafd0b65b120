"""Run spines: the runs a metric is asked for, settled before data meets them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.operators.joins import BROADCAST_BYTES, row_bytes
from claimgauge.session import require_utc, settled


@dataclass(frozen=True)
class Spine:
    """Runs with their ``keys``, ``as_of``, and what is known about them.

    ``lookup`` are the columns naming the tables a run reads. ``first`` and ``last``
    bound a time column over all runs, as constants a scan can prune by. ``small``
    says that the spine passed the size check for a broadcast.
    """

    runs: DataFrame
    keys: tuple[str, ...]
    lookup: tuple[str, ...]
    small: bool
    first: Column
    last: Column

    @classmethod
    def of(cls, runs: DataFrame, keys: Sequence[str], lookup: Sequence[str],
           first: str = "as_of", last: str = "as_of") -> Spine:
        """Settle ``runs``: written once to the scratch folder, then sized.

        Only run-sized frames come here, never claim rows. One row of sizes and
        bounds goes back to the driver.
        """
        require_utc(runs.sparkSession)
        kept = settled(runs, "runs")
        found = kept.agg(F.sum(row_bytes(*kept.columns)).alias("bytes"),
                         F.min(first).cast("string").alias("first"),
                         F.max(last).cast("string").alias("last")).first()
        types = dict(kept.dtypes)
        return cls(kept, tuple(keys), tuple(lookup),
                   (found["bytes"] or 0) <= BROADCAST_BYTES,
                   F.lit(found["first"]).cast(types[first]),
                   F.lit(found["last"]).cast(types[last]))

    @property
    def links(self) -> DataFrame:
        """The runs for joining to data: broadcast if small, else shuffled."""
        return F.broadcast(self.runs) if self.small else self.runs

    @property
    def index(self) -> DataFrame:
        """Just the run keys."""
        return self.runs.select(*self.keys)


def over_runs(spine: DataFrame | None, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run of the spine, with the values of runs that have any."""
    if not keys or spine is None:
        return values
    return spine.join(values, list(keys), "left")
