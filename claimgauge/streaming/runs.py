"""Evaluating events as they arrive: each event once, each batch whole or not at all.

A batch writes to folders of its own and ends with a commit marker; readers join the markers
(:func:`committed`), so what a lost driver left half written is not read. The ids of the
events of committed batches are kept by the day of the event. An event that comes again,
however late, names the same day, so a batch is compared with the ids of just the days
it names: what is held and read does not grow with the age of the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimgauge.operators.routing import asks_of, check_tables, outcomes_of, shared_asks
from claimgauge.plans.evaluate import Evaluation, Tables, write_families
from claimgauge.schemas import METRIC
from claimgauge.session import scratch_scope, settled
from claimgauge.sinks.metrics import write_points
from claimgauge.sources.events import decode_events, quarantined, unique_events

COMMIT = "batch long, events long, failed array<string>"
SEEN = "event_id string, day string, batch long"
#: What a batch writes besides points, with its columns.
FOLDERS = {"outcomes": "event_id string, outcome string, code int, reason string, batch long",
           "quarantine": "event_id string, raw string, decoding string, batch long", "seen": SEEN}


class FamilyFailures(RuntimeError):
    """Some metric families of a batch failed; all others were written."""


@dataclass(frozen=True)
class Job:
    """What a batch of events is evaluated with, and where its results go."""

    path: str
    project: str
    default_namespace: str
    tables: Callable[[], Tables]
    manifest: Callable[[], DataFrame]
    # a failed family fails the batch in the end, so that it is run again
    retry_failures: bool = True
    # pipelines whose events are evaluated; all if not given
    pipelines: tuple[str, ...] | None = None


def _there(spark: SparkSession, schema, path: str, base: str) -> DataFrame:
    """What lies under a path, which may be a pattern; nothing if nothing does."""
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch: its number, its new events and the families that failed."""
    return _there(spark, COMMIT, f"{path}/commits", f"{path}/commits")


def committed(spark: SparkSession, path: str, what: str = "points") -> DataFrame:
    """Points (or ``outcomes``, ``quarantine``, ``seen``) of committed batches, each with its
    ``batch``. Markers are a few bytes a batch; they prune the folders of the others."""
    schema = (METRIC if what == "points" else FOLDERS[what])
    if what == "points":
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in METRIC.fields)
        schema += ", family string, batch long"
    rows = _there(spark, schema, f"{path}/{what}", f"{path}/{what}")
    return rows.join(commits(spark, path).select("batch"), "batch", "left_semi")


def _unseen(came: DataFrame, job: Job) -> DataFrame:
    """Events that no committed batch had. The days a batch names are read back to select
    the folders of their ids: a handful, or as many as the days of a backfill."""
    spark = came.sparkSession
    days = [r["day"] for r in came.select("day").distinct().collect()]
    if not days:
        return came
    base = f"{job.path}/seen"
    known = _there(spark, SEEN, f"{base}/day={{{','.join(sorted(days))}}}", base)
    known = known.join(commits(spark, job.path).select("batch"), "batch", "left_semi")
    return came.join(known.select("event_id", "day"), ["event_id", "day"], "left_anti")


def evaluate_batch(events: DataFrame, batch_id: int, job: Job) -> None:
    """Evaluate raw events and write points, outcomes, the quarantine and the marker.

    Everything goes to folders named after the batch and is overwritten, so a batch that runs
    again leaves one copy; one that was committed is left as it is. Families are
    independent: when one fails, a failure point is written for each of its events and the
    others go on. Ids of events without a readable time are kept under the day of arrival.
    """
    spark = events.sparkSession
    if commits(spark, job.path).where(F.col("batch") == batch_id).limit(1).count():
        return
    with scratch_scope(spark):
        _evaluate(events, f"{batch_id:012d}", job)


def _evaluate(events: DataFrame, batch: str, job: Job) -> None:
    asked = shared_asks(decode_events(events.select("event_id", "raw")))
    came = unique_events(asked.select(
        "event_id", "ask", "as_of", "decoding", "raw", F.coalesce(
            F.col("as_of_day").cast("string"), F.current_date().cast("string")).alias("day")))
    new = settled(_unseen(came, job), "new-events")
    asks = asks_of(asked.join(new.select("ask").distinct(), "ask", "left_semi"))
    if job.pipelines is not None:
        ours = F.coalesce(F.col("pipeline_uuid").isin(*job.pipelines), F.lit(False))
        asks = asks.withColumn("handlers", F.filter("handlers", lambda h: ours))
    checked = check_tables(asks, job.manifest(), job.default_namespace)
    evaluation = Evaluation(checked, job.tables(), job.project, new)

    def write(frame: DataFrame, what: str) -> None:
        frame.write.mode("overwrite").parquet(f"{job.path}/{what}/batch={batch}")

    write(outcomes_of(new, evaluation.routed), "outcomes")
    write(quarantined(new).select("event_id", "raw", "decoding"), "quarantine")
    failed = write_families(evaluation, lambda points, family: write_points(
        points, f"{job.path}/points/batch={batch}", family))
    if failed and job.retry_failures:
        raise FamilyFailures(", ".join(f"{name}: {error}" for name, error in failed.items()))
    (new.select("event_id", "day", F.lit(batch).alias("batch")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch")
     .parquet(f"{job.path}/seen"))
    write(new.agg(F.count(F.lit(1)).alias("events"),
                  F.lit(sorted(failed)).cast("array<string>").alias("failed")), "commits")


def start(events: DataFrame, job: Job, checkpoint: str, **trigger) -> StreamingQuery:
    """Run the job on a stream of raw events (``event_id``, ``raw``)."""
    return (
        events.writeStream.foreachBatch(
            lambda batch, batch_id: evaluate_batch(batch, batch_id, job))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )
