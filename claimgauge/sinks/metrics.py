"""Gauge points: building them from result frames and writing them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.expressions import iso_instant, labels
from claimgauge.schemas import METRIC


def to_points(frame: DataFrame, values: Mapping[str, Column | str],
              label_columns: Mapping[str, Column | str], project: str) -> DataFrame:
    """One point per row and metric; a NULL value is no point.

    ``frame`` has ``event_id`` and ``as_of``; ``values`` maps metric names to columns.
    """
    cells = [F.struct(F.lit(name).alias("metric_name"),
                      (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"))
             for name, v in values.items()]
    points = frame.select(
        F.inline(F.array(*cells)), labels(**label_columns).alias("labels"),
        F.lit(project).alias("project"), F.col("as_of").cast("timestamp").alias("event_time"),
        F.col("event_id").cast("string").alias("event_id"),
    )
    return points.where(F.col("value").isNotNull()).select(*METRIC.names)


def with_metric_names(points: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename metrics, for dashboards that know them by other names."""
    if not names:
        return points
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return points.withColumn("metric_name", F.coalesce(
        F.try_element_at(pairs, F.col("metric_name")), F.col("metric_name")))


def log_lines(points: DataFrame) -> DataFrame:
    """The points as JSON log lines."""
    line = F.to_json(F.struct(
        F.lit("gauge").alias("metric_type"), F.col("project").alias("project_id"),
        F.col("metric_name").alias("name"), F.col("value"), F.col("labels"),
        iso_instant(F.col("event_time")).alias("timestamp"),
    ))
    return points.select("event_id", line.alias("line"))


def write_points(points: DataFrame, path: str, family: str | None = None) -> None:
    """Write points as Parquet, partitioned by metric.

    They are appended, or with a ``family`` replace the folder of that family, so that
    writing the same batch again leaves one copy.
    """
    if family is None:
        points.write.mode("append").partitionBy("metric_name").parquet(path)
    else:
        points.write.mode("overwrite").partitionBy("metric_name").parquet(
            f"{path}/family={family}")


def write_log(points: DataFrame, path: str, mode: str = "append") -> None:
    """Write the JSON log lines as text."""
    log_lines(points).select("line").write.mode(mode).text(path)

