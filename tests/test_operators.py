"""Operators on generated tables: many runs at once must equal one run at a time."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from claimgauge import schemas
from claimgauge.operators import agents, entities, expiry, joins, reconcile, shares
from claimgauge.operators.spine import Spine
from claimgauge.operators.windows import Windows, anchored_window, anchored_windows
from tests.helpers import T0, frame

TENANTS = ["a", "b"]


def with_tenant(schema):
    return type(schema)([*schema.fields]).add("tenant", "string").add("run_id", "string")


def rows_frame(spark, schema, rows):
    return frame(spark, with_tenant(schema), rows).drop("table_ref")


@pytest.fixture(scope="module")
def data(spark):
    """Small random tables of two tenants; one item, invoice and provider hold about a
    third of the rows, and keys and values are sometimes NULL."""
    rng = random.Random(7)

    def pick(hot, choices):
        return hot if rng.random() < 0.33 else rng.choice(choices)

    def when(days):
        return T0 - timedelta(hours=rng.randrange(days * 24), minutes=rng.choice([0, 30]))

    items = [f"i{n}" for n in range(60)] + [None]
    invoices = [f"f{n}" for n in range(12)] + [None]
    people = [f"e{n}" for n in range(25)] + [None]
    statuses = ["SENT_FOR_VALIDATION", "APPROVED", "SUBMITTED_SUCCESS", "EXPIRED", None,
                "NOT_SENT_FOR_VALIDATION"]
    money = [-20.0, 0.0, 10.0, 25.5, None]
    claims, checked, sent, batch = [], [], [], []
    for _ in range(900):
        tenant = pick("a", TENANTS)
        claims.append(dict(
            tenant=tenant, item_id=pick("hot", items), provider_id=pick("hot", people),
            paid_value=rng.choice(money), reported_value=rng.choice(money),
            created_at=when(130), ingested_at=when(12)))
        checked.append(dict(
            tenant=tenant, item_id=pick("hot", items), invoice_id=rng.choice(invoices),
            saving_value=rng.choice(money), status=rng.choice(statuses),
            filtered_reason=rng.choice([None, "OTHER", "SHARED_ID_FATURA"]),
            ingested_at=when(12), updated_at=when(12)))
        sent.append(dict(
            tenant=tenant, item_id=pick("hot", items), saving_value=rng.choice(money),
            status=rng.choice(["SUBMITTED_SUCCESS", "RETRY", None]), ingested_at=when(12),
            submission_run_id=rng.choice(["r1", "r2", "r3"])))
    for _ in range(200):
        batch.append(dict(tenant=rng.choice(TENANTS), run_id=rng.choice(["r1", "r2"]),
                          item_id=pick("hot", items), provider_id=rng.choice(people + ["new"])))
    runs = [(t, r, T0 - timedelta(days=d)) for t in TENANTS
            for r, d in (("r1", 0), ("r2", 3), ("r3", 5), ("idle", 1))]
    frames = {
        "claims": rows_frame(spark, schemas.CLAIMS, claims).drop("run_id"),
        "checked": rows_frame(spark, schemas.VALIDATION, checked).drop("run_id"),
        "sent": rows_frame(spark, schemas.SUBMITTED, sent).drop("run_id"),
        "batch": rows_frame(spark, schemas.CLAIMS, batch),
        "runs": spark.createDataFrame(runs, "tenant string, run_id string, as_of timestamp"),
    }
    return {k: v.cache() for k, v in frames.items()}, runs


def rounded(row, skip=()):
    return tuple(round(v, 9) if isinstance(v, float) else v
                 for k, v in row.asDict().items() if k not in skip)


def keyed(frame_, keys=("tenant", "run_id")):
    found = {}
    for row in frame_.collect():
        found.setdefault(tuple(row[k] for k in keys), set()).add(rounded(row, keys))
    return found


def one(frame_):
    return {rounded(row) for row in frame_.collect()}


def of_tenant(frames, name, tenant):
    return frames[name].where(F.col("tenant") == tenant).drop("tenant")


RUN = ["tenant", "run_id"]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("name", ["new_entity_pct", "volume_ratio"])
def test_entities_by_run(spark, data, name, small):
    frames, runs = data
    spine = Spine.of(frames["runs"], RUN, ["tenant"])
    spine = Spine(spine.runs, spine.keys, spine.lookup, small, spine.first, spine.last)
    found = keyed(getattr(entities, name + "_by_run")(
        spine, frames["batch"], frames["claims"], "provider_id"))
    for tenant, run_id, as_of in runs[small::2]:
        batch = of_tenant(frames, "batch", tenant).where(F.col("run_id") == run_id)
        expected = getattr(entities, name)(
            batch, of_tenant(frames, "claims", tenant), "provider_id", F.lit(as_of))
        assert found[(tenant, run_id)] == one(expected), (tenant, run_id)
    assert len(found) == len(runs)


RECONCILE = {
    "sent_over_received": ("claims", "checked", "sent"),
    "sent_over_accepted": ("claims", "checked", "sent"),
    "sent_over_validation": ("checked", "sent"),
    "shared_invoice_completeness": ("checked", "sent"),
}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("name", RECONCILE)
def test_reconcile_by_run(spark, data, name, small):
    frames, runs = data
    frames = {**frames, "sent": frames["sent"].withColumn("run_id", F.col("submission_run_id"))}
    if name == "sent_over_accepted":
        frames["claims"] = frames["claims"].withColumn("saving_value", F.col("paid_value"))
    spans = anchored_windows(frames["runs"], frames["sent"], RUN)
    windows = Windows.of(spans, RUN, ["tenant"])
    spine = windows.spine
    spine = Spine(spine.runs, spine.keys, spine.lookup, small, spine.first, spine.last)
    windows = Windows(spine, windows.first, windows.last, windows.width_days)
    tables = [frames[t].drop("run_id") for t in RECONCILE[name]]
    found = keyed(getattr(reconcile, name)(*tables, windows))
    for tenant, run_id, as_of in runs[small::2]:
        own = [of_tenant(frames, t, tenant) for t in RECONCILE[name]]
        window = anchored_window(own[-1], run_id, F.lit(as_of))
        expected = one(getattr(reconcile, name)(*own, Windows.single(window)))
        assert found[(tenant, run_id)] == expected, (tenant, run_id)
    assert len(found) == len(runs)


def test_expiry_by_run(spark, data):
    frames, runs = data
    found = keyed(expiry.expired_validation_total_by_run(
        frames["runs"], frames["checked"], RUN, ["tenant"], minutes=2000))
    for tenant, run_id, as_of in runs:
        expected = expiry.expired_validation_total(
            of_tenant(frames, "checked", tenant), F.lit(as_of), minutes=2000)
        assert found[(tenant, run_id)] == one(expected)


def test_shares_by_run(spark, data):
    frames, _ = data
    spine = frames["runs"].select("tenant").distinct().union(
        spark.createDataFrame([("empty",)], "tenant string"))
    rows = frames["claims"]
    part, rest = rows.where("created_at < ingested_at"), rows.where("created_at >= ingested_at")
    found = keyed(shares.filtered_share(part, rest, "paid_value", ["tenant"], spine,
                                        emit="if_positive"), ["tenant"])
    for tenant in TENANTS:
        expected = shares.filtered_share(
            part.where(F.col("tenant") == tenant), rest.where(F.col("tenant") == tenant),
            "paid_value", emit="if_positive")
        assert found[(tenant,)] == one(expected)
    assert found[("empty",)] == {(0.0, None)}


def share(spark, part, rest, **rule):
    def values(numbers):
        return spark.createDataFrame([(n,) for n in numbers], "v double")

    return tuple(shares.filtered_share(
        None if part is None else values(part), None if rest is None else values(rest),
        "v", **rule).first())


def test_share_rules(spark):
    assert share(spark, [], [], emit="if_positive") == (0.0, None)
    assert share(spark, [], [], emit="if_rest_present") == (0.0, 0.0)
    assert share(spark, [5.0], [-10.0]) == (5.0, 0.0)
    assert share(spark, [5.0, None], [0.0], denominator="rest") == (5.0, 0.0)
    assert share(spark, [5.0], None, emit="if_rest_present") == (5.0, None)
    assert share(spark, None, [5.0], emit="if_rest_present") == (0.0, 0.0)
    with pytest.raises(shares.MissingTableError):
        share(spark, [5.0], None, denominator="rest")


def test_null_agent_is_a_group(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, None)],
                                 "agent_id string, saving_value double")
    assert one(agents.savings_by_agent(rows)) == {("a", 1.0, 1), (None, 2.0, 2)}


def test_empty_rule_with_negative_sums(spark):
    def shares_of(sent, total):
        by_status = spark.createDataFrame(sent, "status string, _sent double")
        whole = spark.createDataFrame([(total,)], "_total double")
        return one(reconcile.ratio_with_empty_rule(by_status, whole))

    ok = "SUBMITTED_SUCCESS"
    assert shares_of([(ok, -5.0), ("RETRY", 0.0)], 0.0) == {(ok, 1.0)}
    assert shares_of([(ok, 0.0), ("RETRY", 5.0)], None) == {(ok, 0.0), ("RETRY", 0.0)}
    assert shares_of([(ok, 5.0), ("RETRY", -5.0)], -10.0) == {(ok, 0.0), ("RETRY", 0.0)}
    assert shares_of([(ok, 0.0), (None, 9.0)], 10.0) == {(ok, 0.0), (None, 0.0)}


def test_salted_joins_spread_a_hot_key_and_nulls(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot",), ("2",)], "k string")
    assert joins.salted_semi(left, right, ["k"], ["id"]).count() == 1335
    kept = joins.salted_anti(left, right, ["k"], ["id"])
    assert kept.count() == 4000 - 1335
    assert kept.where("k is null").count() == 1333
    per_salt = joins.salted(left, ["id"]).where("k = 'hot'").groupBy("_salt").count()
    assert per_salt.count() == joins.SALTS
    assert per_salt.agg(F.max("count")).first()[0] < 2 * 1334 / joins.SALTS


@pytest.mark.parametrize("limit", [0, 10**6])
def test_many_and_few_batch_items(spark, data, limit, monkeypatch):
    frames, _ = data
    monkeypatch.setattr(entities, "fits", lambda frame_: limit > 0)
    spine = Spine.of(frames["runs"], RUN, ["tenant"])
    found = keyed(entities.new_entity_pct_by_run(
        spine, frames["batch"], frames["claims"], "provider_id"))
    batch = of_tenant(frames, "batch", "a").where("run_id = 'r1'")
    expected = entities.new_entity_pct(batch, of_tenant(frames, "claims", "a"), "provider_id",
                                       F.lit(T0))
    assert found[("a", "r1")] == one(expected)


def plan_of(frame_):
    return frame_._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_nested_loops_and_push_filters(spark, data):
    frames, _ = data
    spine = Spine.of(frames["runs"], RUN, ["tenant"])
    windows = Windows.of(anchored_windows(
        frames["runs"], frames["sent"].withColumn("run_id", F.col("submission_run_id")), RUN),
        RUN, ["tenant"])
    checked, sent = frames["checked"], frames["sent"]
    for result in (
        entities.new_entity_pct_by_run(spine, frames["batch"], frames["claims"], "provider_id"),
        entities.volume_ratio_by_run(spine, frames["batch"], frames["claims"], "provider_id"),
        reconcile.sent_over_received(frames["claims"], checked, sent, windows),
        reconcile.sent_over_validation(checked, sent, windows),
        expiry.expired_validation_total_by_run(frames["runs"], checked, RUN, ["tenant"]),
    ):
        plan = plan_of(result)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_time_bounds_and_columns_reach_the_scan(spark, data, tmp_path):
    frames, runs = data
    for name in ("claims", "checked", "sent"):
        frames[name].write.parquet(str(tmp_path / name))
    claims, checked, sent = (spark.read.parquet(str(tmp_path / n))
                             for n in ("claims", "checked", "sent"))
    as_of = F.lit(runs[0][2])
    window = Windows.single(anchored_window(sent, "r1", as_of))
    spine = Spine.of(frames["runs"], RUN, ["tenant"])
    for result, column in (
        (entities.new_entity_pct(frames["batch"], claims, "provider_id", as_of), "created_at"),
        (entities.volume_ratio_by_run(spine, frames["batch"], claims, "provider_id"),
         "created_at"),
        (expiry.expired_validation_total(checked, as_of), "updated_at"),
        (reconcile.sendable_items(claims, checked, window), "ingested_at"),
        (reconcile.accepted_items(checked, checked, window), "ingested_at"),
        (reconcile.analysed_items(checked.where("status = 'x'"), window), "ingested_at"),
    ):
        plan = plan_of(result)
        assert f"GreaterThanOrEqual({column}" in plan, plan
        assert "agent_id" not in plan


def test_submissions_are_scanned_once_for_all_items(spark, data, tmp_path):
    frames, _ = data
    frames["sent"].write.parquet(str(tmp_path / "sent"))
    sent = spark.read.parquet(str(tmp_path / "sent"))
    window = Windows.single(anchored_window(sent, "r1", F.lit(T0)))
    checked = frames["checked"]
    both = reconcile.Reconciliation(
        window, sent.select("item_id", "status", "saving_value"),
        received=reconcile.sendable_items(frames["claims"], checked, window),
        analysed=reconcile.analysed_items(checked, window))
    # the items and what was sent of them are tables by now: no plan reads submissions again
    for result in (both.received(), both.by_status("analysed")):
        plan = plan_of(result)
        assert "Scan ExistingRDD" not in plan and str(tmp_path) not in plan
        assert "PartitionFilters: [isnotnull(kind" in plan
    alone = reconcile.sent_over_received(frames["claims"], checked, sent, window)
    plan = plan_of(alone)
    assert "ReadSchema: struct<item_id:string,status:string>" in plan
    assert set(map(tuple, both.received().collect())) == set(map(tuple, alone.collect()))
    other = reconcile.sent_over_validation(checked, sent, window)
    assert set(map(tuple, both.by_status("analysed").collect())) == set(map(tuple, other.collect()))
