"""The claim metrics over the stand-in tables, one function per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.operators import agents, entities, expiry, reconcile, shares, windows
from claimgauge.operators.spine import Spine
from claimgauge.operators.windows import Windows
from claimgauge.sources import standin

NOT_A_RUN = "none"


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per partner at the event time."""
    return standin.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("partner"), standin.as_of().alias("as_of"))


# ---- shares ----------------------------------------------------------------------

def _share(spark, sf_dir, value: str, part: Column, rest: Column, by_partner: bool,
           **rule) -> DataFrame:
    rows = standin.claims(spark, sf_dir, partner=by_partner)
    if by_partner:
        return shares.value_share(rows, value, part, rest, ["partner"], _spine(spark, sf_dir),
                                  **rule)
    return shares.value_share(rows, value, part, rest, **rule)


def prefiltered_share(spark, sf_dir, by_partner=False) -> DataFrame:
    done = F.col("processable")
    return _share(spark, sf_dir, "paid_value", ~done, done, by_partner, emit="if_rest_present")


def processable_share(spark, sf_dir, by_partner=False) -> DataFrame:
    done = F.col("processable")
    return _share(spark, sf_dir, "paid_value", done, ~done, by_partner, emit="if_positive")


def postfiltered_share(spark, sf_dir, by_partner=False) -> DataFrame:
    excluded = F.col("l_returnflag") == "R"
    return _share(spark, sf_dir, "saving_value", excluded, F.lit(True), by_partner,
                  denominator="rest")


def share_missing_rest(spark, sf_dir) -> DataFrame:
    rows = standin.claims(spark, sf_dir)
    return shares.filtered_share(rows.where(~F.col("processable")), None, "paid_value",
                                 emit="if_rest_present")


def share_missing_part(spark, sf_dir) -> DataFrame:
    rows = standin.claims(spark, sf_dir)
    return shares.filtered_share(None, rows.where("processable"), "paid_value",
                                 emit="if_rest_present")


# ---- agents ----------------------------------------------------------------------

def savings_by_agent(spark, sf_dir) -> DataFrame:
    return agents.savings_by_agent(standin.claims(spark, sf_dir, agent=True))


def savings_by_agent_by_partner(spark, sf_dir) -> DataFrame:
    rows = standin.claims(spark, sf_dir, agent=True, partner=True)
    return agents.savings_by_agent(rows, ["partner"])


def selected_savings_by_agent(spark, sf_dir) -> DataFrame:
    rows = standin.selected(standin.claims(spark, sf_dir, agent=True))
    return agents.selected_savings_by_agent(rows)


def selected_savings_by_agent_by_partner(spark, sf_dir) -> DataFrame:
    rows = standin.selected(standin.claims(spark, sf_dir, agent=True, partner=True))
    return agents.selected_savings_by_agent(rows, ["partner"])


# ---- entities --------------------------------------------------------------------

def _new_pct(spark, sf_dir, entity: str) -> DataFrame:
    rows = standin.claims(spark, sf_dir, orders=entity == "member_id")
    return entities.new_entity_pct(standin.batch(rows), rows, entity, standin.as_of())


def _volume(spark, sf_dir, entity: str) -> DataFrame:
    rows = standin.claims(spark, sf_dir, orders=entity == "member_id")
    return entities.volume_ratio(standin.batch(rows), rows, entity, standin.as_of())


def _monthly_runs(spark, sf_dir) -> DataFrame:
    """A run per partner and month with orders, dated the middle of that month."""
    months = standin.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("member_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("run_id"))
    runs = months.join(standin.partners(spark, sf_dir), "member_id").select(
        "partner", "run_id").distinct()
    middle = F.concat("run_id", F.lit("-15 10:30:00")).cast("timestamp_ntz")
    return runs.withColumn("as_of", middle)


def _monthly_batch(rows: DataFrame) -> DataFrame:
    """Rows of the week up to the middle of a month belong to that month's run."""
    day = F.dayofmonth("created_at")
    return rows.where(day.between(9, 15)).withColumn(
        "run_id", F.date_format("created_at", "yyyy-MM"))


def _entity_by_partner(operator, spark, sf_dir, entity: str) -> DataFrame:
    rows = standin.claims(spark, sf_dir, partner=True)
    spine = Spine.of(_spine(spark, sf_dir), ["partner"], ["partner"])
    return operator(spine, standin.batch(rows), rows, entity)


def _entity_by_run(operator, spark, sf_dir, entity: str) -> DataFrame:
    rows = standin.claims(spark, sf_dir, partner=True)
    spine = Spine.of(_monthly_runs(spark, sf_dir), ["partner", "run_id"], ["partner"])
    return operator(spine, _monthly_batch(rows), rows, entity)


# ---- submissions -----------------------------------------------------------------

_DAYS = standin.LOOKBACK_DAYS


def _window(sent: DataFrame, run_id: str = standin.RUN_ID) -> DataFrame:
    return windows.anchored_window(sent, run_id, standin.as_of(), _DAYS)


def submission_window(spark, sf_dir) -> DataFrame:
    return _window(standin.submitted(standin.claims(spark, sf_dir, orders=True)))


def submission_window_fallback(spark, sf_dir) -> DataFrame:
    return _window(standin.submitted(standin.claims(spark, sf_dir, orders=True)), NOT_A_RUN)


def _submission_runs(spark, sf_dir, sent: DataFrame) -> DataFrame:
    """Every run with submissions, and per partner one without any."""
    seen = sent.select("partner", "submission_run_id").distinct()
    idle = standin.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("partner"), F.lit(NOT_A_RUN).alias("submission_run_id"))
    return seen.unionByName(idle).withColumn("as_of", standin.as_of())


_RUN = ["partner", "submission_run_id"]


def submission_windows_by_run(spark, sf_dir) -> DataFrame:
    sent = standin.submitted(standin.claims(spark, sf_dir, partner=True))
    runs = _submission_runs(spark, sf_dir, sent)
    return windows.anchored_windows(runs, sent, _RUN, _DAYS).drop("as_of")


def _single(spark, sf_dir):
    rows = standin.claims(spark, sf_dir, orders=True)
    sent = standin.submitted(rows)
    return rows, standin.validation(rows), sent, Windows.single(_window(sent), _DAYS)


def pending_invoices(spark, sf_dir) -> DataFrame:
    _, checked, _, window = _single(spark, sf_dir)
    return reconcile.pending_invoices(window.of_rows(checked))


def non_sendable_items(spark, sf_dir) -> DataFrame:
    _, checked, _, window = _single(spark, sf_dir)
    return reconcile.non_sendable_items(window.of_rows(checked))


def sendable_items(spark, sf_dir) -> DataFrame:
    rows, checked, _, window = _single(spark, sf_dir)
    items = reconcile.sendable_items(rows, checked, window)
    return items.select("item_id", F.col("paid_value").cast("double").alias("paid_value"),
                        F.col("reported_value").cast("double").alias("reported_value"))


def _by_run(spark, sf_dir):
    rows = standin.claims(spark, sf_dir, partner=True)
    sent = standin.submitted(rows)
    spans = windows.anchored_windows(_submission_runs(spark, sf_dir, sent), sent, _RUN, _DAYS)
    return rows, standin.validation(rows), sent, Windows.of(spans, _RUN, ["partner"], _DAYS)


def _sent_over_received(rows, checked, sent, spans) -> DataFrame:
    return reconcile.sent_over_received(rows, checked, sent, spans)


def _sent_over_accepted(rows, checked, sent, spans) -> DataFrame:
    return reconcile.sent_over_accepted(standin.selected(rows), checked, sent, spans)


def _sent_over_validation(rows, checked, sent, spans) -> DataFrame:
    return reconcile.sent_over_validation(checked, sent, spans)


def _shared_invoice_completeness(rows, checked, sent, spans) -> DataFrame:
    return reconcile.shared_invoice_completeness(checked, sent, spans)


# ---- expiry ----------------------------------------------------------------------

_EXPIRY = {"days": _DAYS}


def expired_validation_total(spark, sf_dir) -> DataFrame:
    checked = standin.validation(standin.claims(spark, sf_dir))
    return expiry.expired_validation_total(checked, standin.as_of(), **_EXPIRY)


def expired_validation_total_by_partner(spark, sf_dir) -> DataFrame:
    checked = standin.validation(standin.claims(spark, sf_dir, partner=True))
    return expiry.expired_validation_total_by_run(_spine(spark, sf_dir), checked, ["partner"],
                                                  ["partner"], **_EXPIRY)


def expired_validation_total_by_run(spark, sf_dir) -> DataFrame:
    checked = standin.validation(standin.claims(spark, sf_dir, partner=True))
    return expiry.expired_validation_total_by_run(
        _monthly_runs(spark, sf_dir), checked, ["partner", "run_id"], ["partner"], **_EXPIRY)


QUERIES = {
    "prefiltered_share": prefiltered_share,
    "prefiltered_share_by_partner": lambda s, d: prefiltered_share(s, d, True),
    "processable_share": processable_share,
    "processable_share_by_partner": lambda s, d: processable_share(s, d, True),
    "postfiltered_share": postfiltered_share,
    "postfiltered_share_by_partner": lambda s, d: postfiltered_share(s, d, True),
    "share_missing_rest": share_missing_rest,
    "share_missing_part": share_missing_part,
    "savings_by_agent": savings_by_agent,
    "savings_by_agent_by_partner": savings_by_agent_by_partner,
    "selected_savings_by_agent": selected_savings_by_agent,
    "selected_savings_by_agent_by_partner": selected_savings_by_agent_by_partner,
    "new_provider_pct": lambda s, d: _new_pct(s, d, "provider_id"),
    "new_provider_pct_by_partner": lambda s, d: _entity_by_partner(
        entities.new_entity_pct_by_run, s, d, "provider_id"),
    "new_provider_pct_by_run": lambda s, d: _entity_by_run(
        entities.new_entity_pct_by_run, s, d, "provider_id"),
    "new_member_pct": lambda s, d: _new_pct(s, d, "member_id"),
    "new_member_pct_by_partner": lambda s, d: _entity_by_partner(
        entities.new_entity_pct_by_run, s, d, "member_id"),
    "new_member_pct_by_run": lambda s, d: _entity_by_run(
        entities.new_entity_pct_by_run, s, d, "member_id"),
    "provider_volume_ratio": lambda s, d: _volume(s, d, "provider_id"),
    "provider_volume_ratio_by_partner": lambda s, d: _entity_by_partner(
        entities.volume_ratio_by_run, s, d, "provider_id"),
    "provider_volume_ratio_by_run": lambda s, d: _entity_by_run(
        entities.volume_ratio_by_run, s, d, "provider_id"),
    "member_volume_ratio": lambda s, d: _volume(s, d, "member_id"),
    "member_volume_ratio_by_partner": lambda s, d: _entity_by_partner(
        entities.volume_ratio_by_run, s, d, "member_id"),
    "member_volume_ratio_by_run": lambda s, d: _entity_by_run(
        entities.volume_ratio_by_run, s, d, "member_id"),
    "submission_window": submission_window,
    "submission_window_fallback": submission_window_fallback,
    "submission_windows_by_run": submission_windows_by_run,
    "pending_invoices": pending_invoices,
    "non_sendable_items": non_sendable_items,
    "sendable_items": sendable_items,
    "sent_over_received": lambda s, d: _sent_over_received(*_single(s, d)),
    "sent_over_received_by_run": lambda s, d: _sent_over_received(*_by_run(s, d)),
    "sent_over_accepted": lambda s, d: _sent_over_accepted(*_single(s, d)),
    "sent_over_accepted_by_run": lambda s, d: _sent_over_accepted(*_by_run(s, d)),
    "sent_over_validation": lambda s, d: _sent_over_validation(*_single(s, d)),
    "sent_over_validation_by_run": lambda s, d: _sent_over_validation(*_by_run(s, d)),
    "shared_invoice_completeness": lambda s, d: _shared_invoice_completeness(*_single(s, d)),
    "shared_invoice_completeness_by_run": lambda s, d: _shared_invoice_completeness(*_by_run(s, d)),
    "expired_validation_total": expired_validation_total,
    "expired_validation_total_by_partner": expired_validation_total_by_partner,
    "expired_validation_total_by_run": expired_validation_total_by_run,
}
