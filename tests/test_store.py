"""Tables by the names events give: published, replaced, emptied, retired, pruned."""

import pytest

from claimgauge import schemas as m
from claimgauge.operators.routing import check_tables, event_outcomes, route_events
from claimgauge.plans.evaluate import Evaluation, Tables
from claimgauge.sources.events import decode_events
from claimgauge.sources.store import TableStore
from tests.helpers import event, frame, point, points, raw_events


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def savings(spark, *rows):
    return frame(spark, m.SAVINGS, [dict(table_ref=t, item_id=i, agent_id=a, saving_value=v)
                                    for t, i, a, v in rows])


def names(spark, *refs):
    return spark.createDataFrame([(r,) for r in refs], "table_ref string")


def listed(store):
    return {(r.table_ref, r.rows) for r in store.manifest().collect()}


def evaluated(spark, store, *events):
    routed = route_events(decode_events(raw_events(spark, *events)))
    tables = Tables(*[store.rows(s) for s in ("claims", "savings", "validation", "submitted")])
    return Evaluation(check_tables(routed, store.manifest(), "main"), tables, "test")


def evaluation_run(table):
    return event("pipesv2_evaluation", {"partner": "acme", "savings_output_table": table})


def agent(value, n, agent_id="x"):
    labels = dict(partner="acme", agent_id=agent_id, approved="false")
    return {point(m.SAVINGS_VALUE, value, **labels), point(m.SAVINGS_COUNT, n, **labels)}


def test_an_unused_store_is_empty(spark, store):
    assert store.manifest().count() == 0 and store.rows("claims").count() == 0


def test_names_with_and_without_a_dot(spark, store):
    store.publish("savings", savings(spark, ("main.s", "1", "x", 5.0), ("other.s", "1", "x", 7.0),
                                     ("other.s", "2", "x", 1.0)))
    for given, expected in (("s", agent(5, 1)), ("main.s", agent(5, 1)), ("other.s", agent(8, 2))):
        assert points(evaluated(spark, store, evaluation_run(given)).savings()) == expected


def test_replaced_emptied_and_retired(spark, store):
    store.publish("savings", savings(spark, ("main.a", "1", "x", 5.0), ("main.b", "1", "x", 2.0)))
    store.publish("savings", savings(spark, ("main.a", "1", "x", 6.0), ("main.a", "2", "x", 1.0)))
    assert listed(store) == {("main.a", 2), ("main.b", 1)}
    assert points(evaluated(spark, store, evaluation_run("a")).savings()) == agent(7, 2)
    # published without rows: there, and empty; what it held before is gone
    store.publish("savings", savings(spark), names(spark, "main.a", "main.c"))
    assert listed(store) == {("main.a", 0), ("main.b", 1), ("main.c", 0)}
    assert points(evaluated(spark, store, evaluation_run("a")).savings()) == set()
    store.retire("savings", names(spark, "main.b"))
    assert listed(store) == {("main.a", 0), ("main.c", 0)}
    store.publish("savings", savings(spark, ("main.b", "1", "x", 3.0)))
    assert points(evaluated(spark, store, evaluation_run("b")).savings()) == agent(3, 1)


def test_empty_is_not_missing(spark, store):
    store.publish("savings", savings(spark, ("main.ex", "1", "x", 5.0)), names(spark, "main.ex", "main.none"))

    def run(savings_table):
        return event("pipesv2_selection", {
            "partner": "acme", "excluded_savings_output_table": "ex", "savings_input_table": savings_table})

    labels = dict(partner="acme", approved="false")
    empty = evaluated(spark, store, run("none"))
    assert points(empty.filtered_post()) == {
        point(m.POST_TOTAL, 5, **labels), point(m.POST_RELATIVE, 0, **labels)}
    missing = evaluated(spark, store, run("gone"))
    assert points(missing.filtered_post()) == set()
    assert [tuple(r)[1:] for r in event_outcomes(missing.routed).collect()] == [
        ("internal_error", 500, None)]


def test_rows_without_a_manifest_entry_are_not_read(spark, store, monkeypatch):
    store.publish("savings", savings(spark, ("main.a", "1", "x", 5.0)))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_note", lost)
        with pytest.raises(RuntimeError):
            store.publish("savings", savings(spark, ("main.a", "1", "x", 99.0)))
    assert store.rows("savings").count() == 2
    assert points(evaluated(spark, store, evaluation_run("a")).savings()) == agent(5, 1)


def test_scans_are_pruned_by_the_names_of_the_events(spark, store):
    store.publish("savings", savings(spark, *[(f"main.t{i}", "1", "x", 1.0) for i in range(200)]))
    found = evaluated(spark, store, evaluation_run("t7")).savings()
    assert points(found) == agent(1, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "Union" not in plan
