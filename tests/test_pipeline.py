"""Streams, sinks and table helpers."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from claimgauge import schemas as m
from claimgauge.plans.evaluate import Evaluation, Tables, write_families
from claimgauge.session import require_utc, scratch_scope, settled
from claimgauge.sinks.metrics import log_lines, to_points, with_metric_names, write_log, write_points
from claimgauge.sources.events import read_events, stream_events
from claimgauge.sources.tables import (
    conform,
    gather,
    manifest_of,
    manifest_of_partitions,
    qualified_name,
    table_or_none,
)
from claimgauge.streaming import runs
from claimgauge.streaming.runs import FamilyFailures, Job, commits, committed, evaluate_batch, start
from tests.helpers import ago, evaluation, event, point, points, raw_events, tables


def savings_event(ref="t.s"):
    return event("pipesv2_evaluation", {"partner": "acme", "savings_output_table": ref})


@pytest.fixture
def job(spark, tmp_path):
    data = tables(spark, savings=[dict(table_ref="t.s", agent_id="x", saving_value=5.0)])
    manifest = manifest_of(data.savings)
    return Job(str(tmp_path / "out"), "test", "main", lambda: data, lambda: manifest)


def write_events(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(
        json.dumps({"event_id": i, "raw": raw}) for i, raw in events))


def run_stream(spark, job, source, checkpoint):
    start(stream_events(spark, str(source)), job, str(checkpoint), availableNow=True
          ).awaitTermination()


EXPECTED = {point(m.SAVINGS_VALUE, 5, partner="acme", agent_id="x", approved="false"),
            point(m.SAVINGS_COUNT, 1, partner="acme", agent_id="x", approved="false"),
            point(m.RUN_COUNT, 1, partner="acme", pipeline_uuid="pipesv2_evaluation",
                  pipeline_status="COMPLETED")}


def test_stream_evaluates_once(spark, job, tmp_path):
    source, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    write_events(source, "a.json", [("1", savings_event()), ("1", savings_event()), ("2", "nope")])
    run_stream(spark, job, source, checkpoint)
    assert points(spark.read.parquet(f"{job.path}/points")) == EXPECTED
    # the same event delivered again, in a new file and a new run of the stream
    write_events(source, "b.json", [("1", savings_event())])
    run_stream(spark, job, source, checkpoint)
    assert points(spark.read.parquet(f"{job.path}/points")) == EXPECTED
    refused = spark.read.parquet(f"{job.path}/quarantine").collect()
    assert [(r.event_id, r.raw, r.decoding) for r in refused] == [("2", "nope", "undecodable")]
    outcomes = spark.read.parquet(f"{job.path}/outcomes").select("event_id", "outcome").collect()
    assert {tuple(r) for r in outcomes} == {("1", "ok"), ("2", "undecodable")}
    # each run was one batch; the ids are kept by the day of the event
    assert {(r.batch, r.events) for r in commits(spark, job.path).collect()} == {(0, 2), (1, 0)}
    assert ("1", "2024-01-15", 0) in {
        (r.event_id, r.day, r.batch) for r in committed(spark, job.path, "seen").collect()}


def test_a_batch_stopped_between_two_families_is_not_read(spark, job, tmp_path, monkeypatch):
    source, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    write_events(source, "a.json", [("1", savings_event())])
    written = []

    def stopping(points_, path, family):
        if written:
            raise KeyboardInterrupt("driver lost")
        written.append(family)
        write_points(points_, path, family)

    with monkeypatch.context() as patch:
        patch.setattr(runs, "write_points", stopping)
        with pytest.raises(BaseException, match="driver lost"):
            evaluate_batch(raw_events(spark, savings_event()), 0, job)
    assert spark.read.parquet(f"{job.path}/points").count() > 0
    assert committed(spark, job.path).count() == 0
    # the ids of a batch that was not committed do not count as seen
    run_stream(spark, job, source, checkpoint)
    assert points(committed(spark, job.path)) == EXPECTED
    assert commits(spark, job.path).count() == 1


def test_events_of_one_run_in_several_batches_and_late_redelivery(spark, job, tmp_path):
    source, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    for batch, ids in enumerate((["1", "2"], ["2", "3"], ["4", "1"])):
        write_events(source, f"{batch}.json", [(i, savings_event()) for i in ids])
        run_stream(spark, job, source, checkpoint)
    found = committed(spark, job.path).where(F.col("metric_name") == m.SAVINGS_VALUE)
    assert sorted((r.event_id, r.batch) for r in found.collect()) == [
        ("1", 0), ("2", 0), ("3", 1), ("4", 2)]


def test_a_committed_batch_is_left_as_it_is(spark, job):
    for ref in ("t.s", "t.gone"):
        evaluate_batch(raw_events(spark, savings_event(ref)), 3, job)
    assert points(committed(spark, job.path)) == EXPECTED


def test_pipelines_of_a_job(spark, job):
    other = Job(job.path, "test", "main", job.tables, job.manifest, pipelines=("another",))
    evaluate_batch(raw_events(spark, savings_event(), "nope"), 0, other)
    assert committed(spark, job.path).count() == 0
    assert {tuple(r)[1:3] for r in committed(spark, job.path, "outcomes").select(
        "event_id", "outcome", "code").collect()} == {("unmatched", 204), ("undecodable", 400)}


def test_batch_replay_overwrites(spark, job):
    events = raw_events(spark, savings_event())
    for _ in range(2):
        evaluate_batch(events, 3, job)
    assert points(spark.read.parquet(f"{job.path}/points")) == EXPECTED


def test_a_failing_family_stops_no_other(spark, job, monkeypatch):
    def fail(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(Evaluation, "savings", fail)
    with pytest.raises(FamilyFailures, match="lost"):
        evaluate_batch(raw_events(spark, savings_event()), 0, job)
    found = points(spark.read.parquet(f"{job.path}/points"))
    assert found == {p for p in EXPECTED if p[0] == m.RUN_COUNT} | {
        point(m.EXECUTION_FAILURE, 1, handler_class="savings/evaluation")}


def test_submission_metrics_that_share_items_fail_alone(spark):
    now = ago(hours=1)
    data = tables(spark, claims=[dict(table_ref="t.p", item_id="1", paid_value=2.0, reported_value=2.0,
                                      ingested_at=now)],
                  savings=[dict(table_ref="t.sel", item_id="1", saving_value=1.0, ingested_at=now)],
                  submitted=[dict(table_ref="t.sub", item_id="1", saving_value=1.0, status="SUBMITTED_SUCCESS",
                                  submission_run_id="r")])
    broken = Tables(data.claims, data.savings.withColumn(
        "saving_value", F.raise_error(F.lit("unreadable")).cast("double")), data.validation, data.submitted)
    run = event("pipesv2_submission", {
        "partner": "acme", "submission_run_id": "r", "processable_claims_historical_table": "t.p",
        "unprocessable_claims_historical_table": "t.u", "internal_validation_output_table": "t.i",
        "manual_validation_output_table": "t.m", "claims_submitted_output_table": "t.sub",
        "selected_savings_historical_table": "t.sel"})
    found = evaluation(spark, broken, run, manifest=["t.p", "t.u", "t.i", "t.m", "t.sub", "t.sel"])
    written = {}
    failed = write_families(found, lambda points_, family: written.update({family: points_.collect()}))
    assert set(failed) == {"sent_over_accepted"}
    assert {r.metric_name for r in written["sent_over_accepted"]} == {m.EXECUTION_FAILURE}
    for family in ("sent_over_received", "sent_over_validation", "shared_invoice"):
        assert written[family] and all(r.value == 1.0 for r in written[family]), family


def test_scratch_folders_go_at_the_end_of_a_scope(spark, tmp_path):
    with scratch_scope(spark):
        kept = settled(spark.range(3), "some")
        path = kept.inputFiles()[0]
        assert kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def sample_points(spark):
    rows = spark.createDataFrame([("e1", "acme", 1.5), ("e2", None, None)],
                                 "event_id string, partner string, v double")
    rows = rows.withColumn("as_of", F.lit("2024-01-15T10:30:00.25Z").cast("timestamp"))
    return to_points(rows, {"a/b": "v", "c": F.lit(2)}, {"partner": F.col("partner"), "x": "y"},
                     "test")


def test_points_and_log(spark, tmp_path):
    found = sample_points(spark)
    assert found.columns == m.METRIC.names
    assert points(found) == {point("a/b", 1.5, partner="acme", x="y"),
                             point("c", 2, partner="acme", x="y"), point("c", 2, x="y")}
    line = json.loads(log_lines(found).where("event_id = 'e1'").orderBy("line").first().line)
    assert line["metric_type"] == "gauge" and line["project_id"] == "test"
    assert line["labels"] == {"partner": "acme", "x": "y"}
    assert line["timestamp"] == "2024-01-15T10:30:00.250000+00:00"
    write_log(found, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == 3
    renamed = with_metric_names(found, {"c": "d"})
    assert {r.metric_name for r in renamed.collect()} == {"a/b", "d"}


def test_write_points(spark, tmp_path):
    path = str(tmp_path / "points")
    for _ in range(2):
        write_points(sample_points(spark), path)
    assert spark.read.parquet(path).count() == 6
    for _ in range(2):
        write_points(sample_points(spark), path + "2", "f")
    assert spark.read.parquet(path + "2").count() == 3
    assert glob.glob(path + "2/family=f/metric_name=a%2Fb")


def test_read_events(spark, tmp_path):
    write_events(tmp_path / "in", "a.json", [("1", "x")])
    assert [tuple(r) for r in read_events(spark, str(tmp_path / "in")).collect()] == [("1", "x")]


def test_tables(spark):
    assert qualified_name("t", "main") == "main.t" and qualified_name("a.t", "main") == "a.t"
    assert table_or_none(spark, "no_such_table") is None
    theirs = spark.createDataFrame([("1", 5)], "item string, amount int")
    theirs.createOrReplaceTempView("known_table")
    assert table_or_none(spark, "known_table").count() == 1
    names = {"item": "item_id", "amount": "saving_value"}
    rows, manifest = gather(spark, ["known_table", "no_such_table"], m.SAVINGS, names)
    assert rows.columns == m.SAVINGS.names
    assert rows.select("table_ref", "item_id", "saving_value", "agent_id").first() == (
        "known_table", "1", 5.0, None)
    assert [r.table_ref for r in manifest.collect()] == ["known_table"]
    assert conform(theirs, m.SAVINGS, names).schema == m.SAVINGS


def test_manifest_from_partitions(spark):
    rows = spark.createDataFrame([("t.a", "1"), ("t b/c", "2"), ("t.a", "3")],
                                 "table_ref string, item_id string")
    rows.write.mode("overwrite").partitionBy("table_ref").saveAsTable("parted_claims")
    try:
        found = manifest_of_partitions(spark, "parted_claims")
        assert {r.table_ref for r in found.collect()} == {"t.a", "t b/c"}
    finally:
        spark.sql("DROP TABLE parted_claims")


def test_other_time_zones_are_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
