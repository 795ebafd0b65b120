"""Counting pipeline runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline_run_points(runs: DataFrame) -> DataFrame:
    """A 1.0 per event, labelled with pipeline, status and, if known, partner.

    ``runs`` has ``event_id``, ``as_of``, ``pipeline_uuid``, ``status``, ``partner``.
    """
    return runs.select("event_id", "as_of", F.lit(1.0).alias("value"), "pipeline_uuid",
                       F.col("status").alias("pipeline_status"), "partner")


def pipeline_run_counts(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The points added up: runs per ``keys``."""
    return points.groupBy(*keys).agg(F.sum("value").alias("runs"))
