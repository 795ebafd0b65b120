"""Queries over run events: decoding, routing, outcomes, whole evaluations, streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge import schemas
from claimgauge.operators import routing, runs
from claimgauge.plans import evaluate
from claimgauge.plans.evaluate import Evaluation, Tables, write_families
from claimgauge.session import scratch_dir
from claimgauge.sinks.metrics import log_lines, to_points, write_points
from claimgauge.sources import standin_events
from claimgauge.sources.events import decode_events, quarantined, stream_events
from claimgauge.sources.standin import table
from claimgauge.sources.store import TableStore
from claimgauge.streaming.runs import Job, committed, start

PROJECT = "test"


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_events(standin_events.noisy_events(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_events(_decoded(spark, sf_dir))


def decode_events_query(spark, sf_dir) -> DataFrame:
    routed = _routed(spark, sf_dir)
    return routed.select("event_id", "decoding", "pipeline_uuid", "status", "partner",
                         F.col("as_of").cast("timestamp_ntz").alias("as_of"))


def decode_quarantine(spark, sf_dir) -> DataFrame:
    return quarantined(_decoded(spark, sf_dir)).select("event_id", "decoding")


def route_events(spark, sf_dir) -> DataFrame:
    return routing.bindings(_routed(spark, sf_dir)).select(
        "event_id", "handler", "metric", "approved", "error",
        F.size("refs").alias("tables"))


def event_outcomes(spark, sf_dir) -> DataFrame:
    return routing.event_outcomes(_routed(spark, sf_dir))


def failure_counts(spark, sf_dir) -> DataFrame:
    failed = routing.failures(_routed(spark, sf_dir))
    return failed.groupBy("stage", "handler", "error").agg(F.count(F.lit(1)).alias("failures"))


def _run_bindings(spark, sf_dir) -> DataFrame:
    bound = routing.bindings(_routed(spark, sf_dir))
    return bound.where((F.col("handler") == routing.RUN_COUNT_HANDLER) & F.col("error").isNull())


def run_points(spark, sf_dir) -> DataFrame:
    points = runs.pipeline_run_points(_run_bindings(spark, sf_dir))
    return points.withColumn("as_of", F.col("as_of").cast("timestamp_ntz"))


def run_counts(spark, sf_dir, *more: str) -> DataFrame:
    points = runs.pipeline_run_points(_run_bindings(spark, sf_dir))
    return runs.pipeline_run_counts(points, ["pipeline_uuid", "pipeline_status", *more])


def metric_log_json(spark, sf_dir) -> DataFrame:
    points = to_points(_run_bindings(spark, sf_dir), {"pipeline_run/count": F.lit(1.0)}, {
        "pipeline_uuid": F.col("pipeline_uuid"), "pipeline_status": F.col("status"),
        "partner": F.col("partner")}, PROJECT)
    return log_lines(points)


# ---- whole evaluations -----------------------------------------------------------

def _flat(points: DataFrame, *more: str) -> DataFrame:
    label = {k: F.try_element_at("labels", F.lit(k)).alias(k)
             for k in ("partner", "approved", "agent_id", "status", "source", *more)}
    return points.select("event_id", "metric_name", "value", *label.values())


def _evaluation(spark, sf_dir, *pipelines: str, gaps: bool = False) -> Evaluation:
    """The run events of some pipelines, out of all that come in, and the tables they read."""
    events = routing.shared_asks(decode_events(standin_events.run_events(spark, sf_dir)), pipelines)
    shapes = sorted({shape for p in pipelines for shape in standin_events.READS[p]})
    tables, manifest = standin_events.publish_run_tables(spark, sf_dir, shapes, gaps)
    checked = routing.check_tables(routing.asks_of(events), manifest, standin_events.NAMESPACE)
    return Evaluation(checked, tables, PROJECT, events)


def pipeline_points(spark, sf_dir, *pipelines: str, gaps: bool = False) -> DataFrame:
    """All points of the runs of some pipelines, but for the run counts."""
    points = _evaluation(spark, sf_dir, *pipelines, gaps=gaps).all_points()
    return _flat(points.where(~F.col("metric_name").isin(
        schemas.RUN_COUNT, schemas.EXECUTION_FAILURE)))


def table_policy_outcomes(spark, sf_dir) -> DataFrame:
    """Outcomes, codes and refusals of all run events where tables are missing or empty."""
    events = routing.shared_asks(decode_events(standin_events.run_events(spark, sf_dir)))
    _, manifest = standin_events.publish_run_tables(
        spark, sf_dir, ("claims", "savings", "validation", "submitted"), gaps=True)
    checked = routing.check_tables(routing.asks_of(events), manifest, standin_events.NAMESPACE)
    return routing.outcomes_of(events, checked)


def failed_family_points(spark, sf_dir) -> DataFrame:
    """Points of approval runs whose claims have members that cannot be read: the families
    that need them leave failure points, all others their values."""
    evaluation = _evaluation(spark, sf_dir, routing.APPROVAL)
    broken = evaluation.tables.claims.withColumn("member_id", F.raise_error(
        F.concat(F.lit("no members in "), F.col("table_ref"))).cast("bigint"))
    evaluation.tables = replace(evaluation.tables, claims=broken)
    out = scratch_dir(spark, "families")
    write_families(evaluation, lambda points, family: write_points(points, out, family))
    points = spark.read.schema(schemas.METRIC).parquet(out)
    return _flat(points.where(F.col("metric_name") != schemas.RUN_COUNT), "handler_class")


def failure_points(spark, sf_dir) -> DataFrame:
    """The failure points of the noisy events; they are stamped with the time of evaluation."""
    points = evaluate.failure_points(_routed(spark, sf_dir), PROJECT)
    return points.select("event_id", "metric_name", "value", F.try_element_at(
        "labels", F.lit("handler_class")).alias("handler_class"))


# ---- streams ---------------------------------------------------------------------

ARRIVALS = 3


def _arriving(events: DataFrame, arrival: int) -> DataFrame:
    """What comes in at an arrival: a third of the events, so that the runs of a day come in
    all of them, and again some of those that came before."""
    n = F.col("event_id")
    new = n % ARRIVALS == arrival
    again = (n % ARRIVALS < arrival) & (n % 5 == 0)
    return events.where(new | again)


def _streamed(spark, sf_dir, out: str, raw, job: Job) -> None:
    """Run the job on arrivals of ``raw`` events, started anew for each of them."""
    feed = f"{out}/feed"
    for arrival in range(ARRIVALS):
        events = _arriving(table(spark, sf_dir, "events"), arrival)
        raw(events).write.mode("append").parquet(feed)
        start(stream_events(spark, feed, "parquet"), job, f"{out}/checkpoint",
              availableNow=True).awaitTermination()


def _stream_of_noise(spark, sf_dir, purpose: str) -> str:
    """Noisy events streamed in; gives the folder of what the job wrote."""
    out = scratch_dir(spark, purpose)
    store = TableStore(spark, f"{out}/tables")
    none = Tables(*[store.rows(shape) for shape in ("claims", "savings", "validation", "submitted")])
    job = Job(f"{out}/results", PROJECT, standin_events.NAMESPACE, lambda: none, store.manifest)
    spread = spark.sparkContext.defaultParallelism
    _streamed(spark, sf_dir, out, lambda events: standin_events.as_noisy_events(
        events.repartition(spread, "event_id")), job)
    return job.path


def stream_run_counts(spark, sf_dir) -> DataFrame:
    """Run counts, from the committed points of three arrivals."""
    points = committed(spark, _stream_of_noise(spark, sf_dir, "stream-runs"))
    counted = points.where(F.col("metric_name") == schemas.RUN_COUNT)
    return counted.groupBy(F.col("labels")["pipeline_uuid"].alias("pipeline_uuid"),
                           F.col("labels")["pipeline_status"].alias("pipeline_status")
                           ).agg(F.sum("value").alias("runs"))


def stream_dedup(spark, sf_dir) -> DataFrame:
    """Every event is taken up once, however often and late it comes."""
    outcomes = committed(spark, _stream_of_noise(spark, sf_dir, "stream-dedup"), "outcomes")
    kinds = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type")
    return outcomes.join(kinds, "event_id").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"),
        F.count_distinct("batch").alias("batches"))


def stream_savings(spark, sf_dir) -> DataFrame:
    """Run events streamed in and evaluated per micro-batch against the tables they name; the
    committed savings points of evaluation runs are read back."""
    out = scratch_dir(spark, "stream-savings")
    tables, manifest = standin_events.publish_run_tables(
        spark, sf_dir, standin_events.READS[routing.EVALUATION])
    job = Job(f"{out}/results", PROJECT, standin_events.NAMESPACE, lambda: tables, lambda: manifest,
              pipelines=(routing.EVALUATION,))
    region = table(spark, sf_dir, "region")
    _streamed(spark, sf_dir, out, lambda events: standin_events.as_run_events(events, region), job)
    return _flat(committed(spark, job.path).where(F.col("family") == "savings"))


QUERIES = {
    "run_points": run_points,
    "run_counts": run_counts,
    "run_counts_by_partner": lambda s, d: run_counts(s, d, "partner"),
    "decode_events": decode_events_query,
    "decode_quarantine": decode_quarantine,
    "event_outcomes": event_outcomes,
    "failure_counts": failure_counts,
    "route_events": route_events,
    "metric_log_json": metric_log_json,
    "approval_points": lambda s, d: pipeline_points(s, d, routing.APPROVAL),
    "wrangling_points": lambda s, d: pipeline_points(s, d, routing.WRANGLING),
    "selection_points": lambda s, d: pipeline_points(s, d, routing.SELECTION),
    "evaluation_points": lambda s, d: pipeline_points(s, d, routing.EVALUATION),
    "submission_points": lambda s, d: pipeline_points(s, d, routing.SUBMISSION),
    "release_points": lambda s, d: pipeline_points(s, d, routing.RELEASE),
    "event_mix_points": lambda s, d: pipeline_points(s, d, *standin_events.READS),
    "table_policy_points": lambda s, d: pipeline_points(
        s, d, *[p for p in standin_events.READS if p != routing.SUBMISSION], gaps=True),
    "table_policy_outcomes": table_policy_outcomes,
    "failed_family_points": failed_family_points,
    "failure_points": failure_points,
    "stream_run_counts": stream_run_counts,
    "stream_dedup": stream_dedup,
    "stream_savings": stream_savings,
}
