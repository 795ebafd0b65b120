"""Work that must not grow with repeats: asks shared by events, shuffles dropped, roll-ups."""

import os
import time

from pyspark.sql import functions as F

from claimgauge import schemas as m
from claimgauge.operators import routing
from claimgauge.operators.entities import new_entity_pct_by_run
from claimgauge.operators.spine import Spine
from claimgauge.plans.evaluate import Evaluation, write_families
from claimgauge.session import settled
from claimgauge.sources.events import decode_events
from claimgauge.sources.store import TableStore
from claimgauge.sources.tables import manifest_of
from tests.helpers import ago, event, frame, raw_events, tables


def runs(n, **variables):
    given = {"partner": "acme", "savings_output_table": "t.s", **variables}
    return [event("pipesv2_evaluation", given, when=f"2024-01-15T10:30:{i:02d}.000{i:03d}Z") for i in range(n)]


def release(when):
    return event("pipesv2_release", {"partner": "acme", "internal_validation": {
        "internal_validation_claims_input_table": "t.i"}, "manual_validation": {
        "manual_validation_claims_input_table": "t.m"}}, when=when)


def both_ways(spark, data, *given):
    """The evaluation of events by themselves and by the asks they share."""
    manifest = manifest_of(data.claims, data.savings, data.validation, data.submitted)
    decoded = decode_events(raw_events(spark, *given))
    alone = Evaluation(routing.check_tables(routing.route_events(decoded), manifest, "main"), data, "test")
    events = routing.shared_asks(decoded)
    checked = routing.check_tables(routing.asks_of(events), manifest, "main")
    return alone, Evaluation(checked, data, "test", events)


def told(frame_):
    return sorted((r.event_id, r.metric_name, r.value, str(r.event_time), str(sorted(r.labels.items())))
                  for r in frame_.collect())


def test_events_that_ask_the_same_are_evaluated_once(spark):
    data = tables(spark, savings=[dict(table_ref="t.s", item_id="1", agent_id="x", saving_value=2.0)],
                  validation=[dict(table_ref=t, item_id="1", status="EXPIRED", saving_value=3.0,
                                   ingested_at=ago(hours=1), updated_at=ago(minutes=5)) for t in ("t.i", "t.m")])
    given = [*runs(9), *runs(1, partner="other"), release("2024-01-15T10:30:00.000001Z"),
             release("2024-01-15T10:30:00.000002Z"), release("2024-01-15T13:30:00Z"),
             "nope", event("pipesv2_evaluation", None), event("pipesv2_evaluation", {"partner": None})]
    alone, shared = both_ways(spark, data, *given)
    assert shared.routed.count() == 8  # times count for releases only, whatever lies between them
    wanted = alone.wanted()
    assert wanted == shared.wanted()
    for family in wanted:
        if family != "failure_points":  # stamped with the time of evaluation
            assert told(getattr(alone, family)()) == told(shared.of_events(getattr(shared, family)())), family
    assert shared.all_points().count() == alone.all_points().count()
    outcomes = routing.event_outcomes(alone.routed)
    assert sorted(map(tuple, routing.outcomes_of(shared.events, shared.routed).collect())) == sorted(
        map(tuple, outcomes.collect()))


def test_a_lost_family_is_a_failure_of_each_event(spark, monkeypatch):
    def fail(self):
        raise RuntimeError("lost")

    data = tables(spark, savings=[dict(table_ref="t.s", item_id="1", agent_id="x", saving_value=2.0)])
    monkeypatch.setattr(Evaluation, "savings", fail)
    _, shared = both_ways(spark, data, *runs(3))
    written = {}
    assert set(write_families(shared, lambda p, family: written.update({family: p.collect()}))) == {"savings"}
    assert sorted((r.event_id, r.metric_name) for r in written["savings"]) == [
        (f"e{i}", m.EXECUTION_FAILURE) for i in range(3)]


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.startswith("shuffle_") for top in dirs for _, _, names in os.walk(top) for f in names)


def test_what_is_settled_or_published_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    kept = settled(spark.range(1000).repartition(7), "some")
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish("savings", frame(spark, m.SAVINGS, [dict(table_ref=f"t.{i % 3}", item_id=str(i), saving_value=1.0)
                                                      for i in range(30)]).repartition(5))
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert kept.count() == 1000 and store.rows("savings").count() == 30


def test_batch_items_beyond_a_broadcast_are_not_copied(spark):
    day = ago()
    history = spark.createDataFrame(
        [("h", i, e, day) for i, e in ((1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, "c"), (3, "c"), (3, None))],
        "history_set string, item_id long, provider_id string, created_at timestamp")
    batch = spark.createDataFrame([("q", i, e) for i, e in ((1, "a"), (2, "b"), (None, "c"), (9, "d"), (9, "d"))],
                                  "question string, item_id long, provider_id string")
    asked = spark.createDataFrame([("q", "h", day.date())], "question string, history_set string, as_of_day date")
    spine = Spine.of(asked, ["question"], ["history_set"], "as_of_day", "as_of_day")
    found = {fit: new_entity_pct_by_run(spine, batch, history, "provider_id", items_fit=fit) for fit in (True, False)}
    assert "_salt" not in found[False]._jdf.queryExecution().optimizedPlan().toString()
    # a and b are known by items of the batch only, c by others, d not at all
    assert found[True].collect() == found[False].collect()
    assert [tuple(r)[1:3] for r in found[False].collect()] == [(4, 3)]
