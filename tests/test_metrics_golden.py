"""Hand-computed cases, from raw events to gauge points."""

from claimgauge import schemas as m
from tests.helpers import T0, ago, evaluation, event, point, points, tables

TAKEN = {"partner": "acme", "approved": "true"}


def approval(**variables):
    return event("pipesv2_approval", {"partner": "acme", **variables})


def submission(**variables):
    return event("pipesv2_submission", {"partner": "acme", "submission_run_id": "run_x",
                                        **variables})


PAIR = {"unprocessable_claims_input_table": "t.un", "processable_claims_input_table": "t.ok"}
PAID = [dict(table_ref="t.un", paid_value=v) for v in (300.0, 400.0, 300.0)] + [
    dict(table_ref="t.ok", paid_value=v) for v in (1000.0, 1500.0, 1500.0)]


def test_prefiltered_and_processable(spark):
    run = evaluation(spark, tables(spark, PAID), approval(**PAIR))
    assert points(run.filtered_pre()) == {
        point(m.PRE_TOTAL, 1000, **TAKEN), point(m.PRE_RELATIVE, 0.2, **TAKEN)}
    assert points(run.processable()) == {
        point(m.PROCESSABLE_TOTAL, 4000, **TAKEN), point(m.PROCESSABLE_RELATIVE, 0.8, **TAKEN)}


def test_share_with_missing_tables(spark):
    only_rest = tables(spark, [r for r in PAID if r["table_ref"] == "t.ok"])
    run = evaluation(spark, only_rest, approval(**PAIR))
    assert points(run.filtered_pre()) == {
        point(m.PRE_TOTAL, 0, **TAKEN), point(m.PRE_RELATIVE, 0, **TAKEN)}
    only_part = tables(spark, [r for r in PAID if r["table_ref"] == "t.un"])
    run = evaluation(spark, only_part, approval(**PAIR))
    assert points(run.filtered_pre()) == {point(m.PRE_TOTAL, 1000, **TAKEN)}
    assert points(run.processable()) == {
        point(m.PROCESSABLE_TOTAL, 0, **TAKEN), point(m.PROCESSABLE_RELATIVE, 0, **TAKEN)}
    run = evaluation(spark, tables(spark), approval(**PAIR))
    assert points(run.processable()) == {point(m.PROCESSABLE_TOTAL, 0, **TAKEN)}


def test_empty_table_is_not_missing(spark):
    run = evaluation(spark, tables(spark), approval(**PAIR), manifest=["t.un", "t.ok"])
    assert points(run.filtered_pre()) == {
        point(m.PRE_TOTAL, 0, **TAKEN), point(m.PRE_RELATIVE, 0, **TAKEN)}


def test_postfiltered(spark):
    rows = [dict(table_ref="t.x", saving_value=v) for v in (150.0, 200.0, 150.0)] + [
        dict(table_ref="t.s", saving_value=v) for v in (500.0, 750.0, 750.0)]
    names = {"excluded_savings_input_table": "t.x", "savings_input_table": "t.s"}
    run = evaluation(spark, tables(spark, savings=rows), approval(**names))
    assert points(run.filtered_post()) == {
        point(m.POST_TOTAL, 500, **TAKEN), point(m.POST_RELATIVE, 0.25, **TAKEN)}
    # without the savings table the metric fails, and says so
    run = evaluation(spark, tables(spark, savings=rows[:3]), approval(**names))
    assert points(run.filtered_post()) == set()
    assert point(m.EXECUTION_FAILURE, 1, handler_class="filtered_post/approval") in points(
        run.failure_points())


def test_savings_per_agent(spark):
    rows = [dict(table_ref="main.s", agent_id=a, saving_value=v)
            for a, v in (("C035", 100.0), ("C035", 200.0), ("R001", 300.0), (None, 5.0))]
    run = evaluation(spark, tables(spark, savings=rows), event(
        "pipesv2_evaluation", {"partner": "acme", "savings_output_table": "s"}))
    labels = {"partner": "acme", "approved": "false"}
    assert points(run.savings()) == {
        point(name, value, agent_id=agent, **labels)
        for agent, total, count in (("C035", 300, 2), ("R001", 300, 1), ("None", 5, 1))
        for name, value in ((m.SAVINGS_VALUE, total), (m.SAVINGS_COUNT, count))}
    run = evaluation(spark, tables(spark), event(
        "pipesv2_evaluation", {"partner": "acme", "savings_output_table": "s"}))
    assert points(run.savings()) == set()


def test_selected_savings(spark):
    rows = [dict(table_ref="t.sel", agent_id=a, saving_value=v) for a, v in (
        ("agent_1", 100.0), ("agent_1", 200.0), ("agent_2", 300.0), ("agent_2", 150.0),
        ("agent_3", 50.0))]
    run = evaluation(spark, tables(spark, savings=rows),
                     approval(selected_savings_input_table="t.sel"))
    assert points(run.selected_savings()) == {
        point(m.SELECTED_VALUE, v, partner="acme", source="selected_savings", agent_id=a)
        for a, v in (("agent_1", 300), ("agent_2", 450), ("agent_3", 50))}


FOUR = {**PAIR, "unprocessable_claims_output_table": "h.un",
        "processable_claims_output_table": "h.ok"}


def entity_rows(batch_ok, batch_un, history):
    """(item, entity) of the batches; (item, entity, days before the event) of history.
    The entity is both provider and member."""
    rows = [dict(table_ref=t, item_id=i, provider_id=e, member_id=e)
            for t, pairs in (("t.ok", batch_ok), ("t.un", batch_un)) for i, e in pairs]
    rows += [dict(table_ref="h.ok", item_id=i, provider_id=e, member_id=e,
                  created_at=ago(days=d)) for i, e, d in history]
    return rows


def entity_values(spark, rows, manifest=("t.ok", "t.un", "h.ok", "h.un")):
    run = evaluation(spark, tables(spark, rows), approval(**FOUR), manifest=manifest)
    found = {}
    for name in ("new_providers", "new_members", "provider_ratio", "member_ratio"):
        values = [p[1] for p in points(getattr(run, name)())]
        assert len(values) == 1
        found[name] = values[0]
    assert found["new_providers"] == found["new_members"]
    assert found["provider_ratio"] == found["member_ratio"]
    return found["new_providers"], found["provider_ratio"]


def test_new_entities_against_90_days(spark):
    rows = entity_rows([("b1", "1"), ("b2", "2"), ("b3", "3")], [("b4", "1"), ("b5", "4")],
                       [("x1", "1", 90), ("x2", "2", 90), ("x3", "3", 90), ("x4", "5", 91)])
    assert entity_values(spark, rows)[0] == 0.25


def test_new_entities_date_floor(spark):
    # ninety days back at the event's own clock time is in; a day more is out
    rows = entity_rows([("b1", "1"), ("b2", "2")], [], [("x1", "1", 90), ("x2", "2", 91)])
    assert entity_values(spark, rows)[0] == 0.5


def test_new_entities_ignore_the_batch_in_history(spark):
    rows = entity_rows([("i1", "1"), ("i2", "2")], [],
                       [("i1", "1", 90), ("x3", "2", 90), ("x4", "3", 90)])
    assert entity_values(spark, rows)[0] == 0.5


def test_new_entities_without_history_or_batch(spark):
    rows = entity_rows([("b1", "1")], [("b2", "2")], [])
    assert entity_values(spark, rows)[0] == 1.0
    assert entity_values(spark, rows, ("t.ok", "t.un")) == (1.0, 1.0)
    assert entity_values(spark, [], ("t.ok", "t.un", "h.ok", "h.un")) == (0.0, 1.0)


def test_missing_batch_is_refused(spark):
    run = evaluation(spark, tables(spark), approval(**FOUR), manifest=["t.ok", "h.ok", "h.un"])
    assert points(run.new_providers()) == set()
    assert point(m.EXECUTION_FAILURE, 1, handler_class="member_ratio/approval") in points(
        run.failure_points())


def test_volume_ratio(spark):
    history = [("x", "3", 5), *[("x", e, 40) for e in "4578"], ("x", "6", 61), ("x", "9", 61)]
    rows = entity_rows([("b1", "1"), ("b2", "2")], [], history)
    assert entity_values(spark, rows)[1] == 0.75
    rows = entity_rows([("b1", "1")], [], [("x", "2", 40), ("x", "3", 40), ("x", "4", 61)])
    assert entity_values(spark, rows)[1] == 0.5
    # nothing before: 1, even with nothing now; something before and nothing now: 0
    assert entity_values(spark, entity_rows([("b", "1")], [], [("x", "1", 1)]))[1] == 1.0
    assert entity_values(spark, entity_rows([], [], [("x", "1", 40)]))[1] == 0.0


ANCHOR = T0.replace(day=14, hour=20, minute=0)
DAY, OLD, NEW = ago(ANCHOR, days=1), ago(ANCHOR, days=3), ago(ANCHOR, minutes=-5)
SETS = {"internal_validation_output_table": "v.i", "manual_validation_output_table": "v.m",
        "claims_submitted_output_table": "s.sub"}


def test_sent_over_received(spark):
    def received(ref, rows):
        return [dict(table_ref=ref, item_id=i, paid_value=p, reported_value=r, ingested_at=t)
                for i, p, r, t in rows]

    claims = received("h.ok", [
        ("p1", 1000.0, 1000.0, OLD), ("p2", 50.0, 100.0, DAY), ("p3", 300.0, 300.0, DAY),
        ("p4", 50.0, 100.0, ANCHOR), ("p5", 50.0, 50.0, ANCHOR), ("p6", 550.0, 450.0, ANCHOR),
        ("p7", 550.0, 450.0, ANCHOR), ("p8", 225.0, 175.0, ANCHOR), ("p9", 225.0, 175.0, ANCHOR),
        ("p10", 1000.0, 1000.0, NEW), ("p11", 1000.0, 1000.0, NEW)])
    claims += received("h.un", [
        ("u1", 1000.0, 1000.0, OLD), ("u2", 200.0, 250.0, DAY), ("u3", 150.0, 200.0, ANCHOR),
        ("u4", 1000.0, 1000.0, NEW)])

    def checked(ref, rows):
        return [dict(table_ref=ref, item_id=i, invoice_id=f, status=s, ingested_at=ANCHOR)
                for i, f, s in rows]

    validation = checked("v.i", [("p3", "f0", "EXPIRED"), ("p4", "f1", "DENIED"),
                                 ("p5", "f1", "APPROVED"), ("p6", "f2", "SENT_FOR_VALIDATION"),
                                 ("p7", "f2", "APPROVED")])
    validation += checked("v.m", [("p8", "f3", "SENT_FOR_VALIDATION"), ("p9", "f3", "DENIED")])
    sent = [dict(table_ref="s.sub", item_id=i, status=s, submission_run_id="run_x", ingested_at=t)
            for i, s, t in (("p3", "SUBMITTED_SUCCESS", DAY), ("p4", "SUBMITTED_ERROR", ANCHOR),
                            ("u2", "RETRY", DAY))]
    names = {"processable_claims_historical_table": "h.ok",
             "unprocessable_claims_historical_table": "h.un", **SETS}
    run = evaluation(spark, tables(spark, claims, (), validation, sent), submission(**names))

    def expected(shares):
        return {point(name, value, partner="acme", status=status)
                for status, paid, reported in shares
                for name, value in ((m.SENT_PAID, paid), (m.SENT_REPORTED, reported))}

    assert points(run.sent_over_received()) == expected([
        ("RETRY", .25, .25), ("SUBMITTED_ERROR", .0625, .1), ("SUBMITTED_SUCCESS", .375, .3)])

    # the same item submitted again and again counts each time
    run = evaluation(spark, tables(spark, claims, (), validation, sent + [sent[0]] * 2),
                     submission(**names))
    shares = {p[2]: p[1] for p in points(run.sent_over_received()) if p[0] == m.SENT_PAID}
    assert shares[(("partner", "acme"), ("status", "SUBMITTED_SUCCESS"))] == 1.125

    # nothing of this run submitted: the window ends 20 minutes before the event
    idle = [dict(s, submission_run_id="other", item_id="zz") for s in sent]
    recent = [dict(claims[1], ingested_at=ago(minutes=20)), dict(claims[2], ingested_at=ago())]
    every = ["h.ok", "h.un", "v.i", "v.m", "s.sub"]
    run = evaluation(spark, tables(spark, recent, (), (), idle), submission(**names),
                     manifest=every)
    assert points(run.sent_over_received()) == expected([("SUBMITTED_SUCCESS", 0, 0)])
    run = evaluation(spark, tables(spark), submission(**names), manifest=every)
    assert points(run.sent_over_received()) == expected([("SUBMITTED_SUCCESS", 1, 1)])


def saved(ref, rows, when=DAY, **more):
    return [dict(table_ref=ref, item_id=i, saving_value=v, invoice_id=f, status=s,
                 ingested_at=when, **more) for i, f, v, s in rows]


def sent_rows(rows, run="run_x"):
    """Submitted rows, and one for an unknown item that sets the anchor."""
    return [dict(table_ref="s.sub", item_id=i, saving_value=v, status=s, submission_run_id=run,
                 ingested_at=t) for i, v, s, t in rows]


def by_status(metric, **shares):
    return {point(metric, v, partner="acme", status=s) for s, v in shares.items()}


def test_sent_over_accepted(spark):
    selected = [dict(table_ref="h.sel", item_id="s1", saving_value=1000.0, ingested_at=DAY),
                dict(table_ref="h.sel", item_id="s2", saving_value=2000.0, ingested_at=OLD)]
    checked = saved("v.i", [
        ("i1", "f1", 500.0, "APPROVED"), ("i2", "f1", 100.0, "REJECTED"),
        ("i3", "f1", 200.0, "SUBMITTED_SUCCESS"), ("i4", "f2", 100.0, "SENT_FOR_VALIDATION"),
        ("i5", "f2", 100.0, "APPROVED")])
    checked += saved("v.m", [
        ("m1", "f3", 300.0, "SUBMITTED_SUCCESS"), ("m2", "f3", 50.0, "REJECTED"),
        ("m3", "f4", 100.0, "SENT_FOR_VALIDATION"), ("m4", "f4", 100.0, "APPROVED")])
    sent = sent_rows([("s1", 400.0, "SUBMISSION_SUCCESS", DAY),
                      ("i1", 200.0, "SUBMISSION_ERROR", DAY), ("i3", 100.0, "RETRY", ANCHOR),
                      ("other", 999.0, "SUBMISSION_SUCCESS", DAY)])
    names = {"selected_savings_historical_table": "h.sel", **SETS}
    run = evaluation(spark, tables(spark, (), selected, checked, sent), submission(**names))
    assert points(run.sent_over_accepted()) == by_status(
        m.SENT_ACCEPTED, SUBMISSION_SUCCESS=.2, SUBMISSION_ERROR=.1, RETRY=.05,
        SUBMITTED_SUCCESS=0)

    # fallback window, no invoice ids, a NULL status, and a submission of another run
    late = ago(minutes=20)
    checked = saved("v.i", [("i1", None, 500.0, "APPROVED"), ("i9", None, 7.0, None)], late)
    checked += saved("v.m", [("m1", None, 300.0, "SUBMITTED_SUCCESS"),
                             ("m2", None, 9.0, "SENT_FOR_VALIDATION")], late)
    selected = [dict(table_ref="h.sel", item_id="s1", saving_value=1000.0, ingested_at=late)]
    sent = sent_rows([("i1", 200.0, "SUBMITTED_SUCCESS", OLD)], run="other")
    run = evaluation(spark, tables(spark, (), selected, checked, sent), submission(**names))
    assert points(run.sent_over_accepted()) == by_status(
        m.SENT_ACCEPTED, SUBMITTED_SUCCESS=200 / 1800)

    every = ["h.sel", "v.i", "v.m", "s.sub"]
    run = evaluation(spark, tables(spark), submission(**names), manifest=every)
    assert points(run.sent_over_accepted()) == by_status(m.SENT_ACCEPTED, SUBMITTED_SUCCESS=1)
    # a missing table is an error, not a 1.0
    run = evaluation(spark, tables(spark), submission(**names), manifest=every[1:])
    assert points(run.sent_over_accepted()) == set()
    assert points(run.sent_over_validation()) == by_status(
        m.SENT_VALIDATION, SUBMITTED_SUCCESS=1)


def test_sent_over_validation(spark):
    checked = saved("v.i", [
        ("i1", "f1", 500.0, "APPROVED"), ("i3", "f3", 200.0, "EXCLUDED"),
        ("i4", "f4", 150.0, "EXPIRED"), ("i5", "f5", 100.0, "SENT_FOR_VALIDATION"),
        ("i6", "f5", 77.0, None)])
    checked += saved("v.i", [("i2", "f2", 300.0, "APPROVED")], filtered_reason="SHARED_ID_FATURA")
    checked += saved("v.m", [("m1", "f6", 400.0, "SUBMITTED_SUCCESS")])
    sent = sent_rows([("i1", 400.0, "SUBMITTED_SUCCESS", DAY), ("i3", 100.0, "RETRY", ANCHOR),
                      ("i2", 300.0, "SUBMITTED_SUCCESS", DAY)])
    run = evaluation(spark, tables(spark, (), (), checked, sent), submission(**SETS))
    assert points(run.sent_over_validation()) == by_status(
        m.SENT_VALIDATION, SUBMITTED_SUCCESS=400 / 1250, RETRY=100 / 1250)

    # items of a pending invoice stay in
    checked = saved("v.i", [("a", "f1", 500.0, "APPROVED"), ("b", "f2", 200.0, "APPROVED"),
                            ("c", "f2", 100.0, "SENT_FOR_VALIDATION")])
    sent = sent_rows([("a", 500.0, "SUBMITTED_SUCCESS", ANCHOR)])
    run = evaluation(spark, tables(spark, (), (), checked, sent), submission(**SETS),
                     manifest=list(SETS.values()))
    assert points(run.sent_over_validation()) == by_status(
        m.SENT_VALIDATION, SUBMITTED_SUCCESS=500 / 700)


def test_shared_invoice_completeness(spark):
    def value(rows, sent, manifest=tuple(SETS.values())):
        run = evaluation(spark, tables(spark, (), (), rows, sent), submission(**SETS),
                         manifest=manifest)
        (found,) = points(run.shared_invoice())
        assert found[2] == (("partner", "acme"),)
        return found[1]

    shared = {"filtered_reason": "SHARED_ID_FATURA"}
    rows = saved("v.i", [("a", "f", 600.0, "APPROVED")], **shared)
    rows += saved("v.m", [("b", "f", 400.0, "NOT_SENT_FOR_VALIDATION"),
                          ("c", "f", 50.0, "SENT_FOR_VALIDATION")], **shared)
    sent = sent_rows([("a", 600.0, "SUBMITTED_SUCCESS", ANCHOR)])
    assert value(rows, sent) == 0.6
    assert value(rows[:1], sent) == 1.0
    assert value([], []) == 1.0


def test_expired(spark):
    inside, edge = ago(days=1), ago(minutes=30)
    rows = [dict(table_ref=ref, item_id="i", saving_value=v, status=s, ingested_at=i, updated_at=u)
            for ref, v, s, i, u in (
        ("v.i", 100.0, "EXPIRED", inside, edge), ("v.i", 200.0, "EXPIRED", inside, edge),
        ("v.i", 50.0, "APPROVED", inside, edge), ("v.i", 1000.0, "EXPIRED", ago(days=3), edge),
        ("v.i", 500.0, "EXPIRED", inside, ago(minutes=45)),
        ("v.m", 150.0, "EXPIRED", inside, edge), ("v.m", 75.0, "EXPIRED", ago(days=2), ago()))]
    release = event("pipesv2_release", {
        "partner": "acme",
        "internal_validation": {"internal_validation_claims_input_table": "v.i"},
        "manual_validation": {"manual_validation_claims_input_table": "v.m"}})
    run = evaluation(spark, tables(spark, validation=rows), release)
    assert points(run.expired()) == {point(m.EXPIRED_TOTAL, 525, partner="acme")}
    run = evaluation(spark, tables(spark), release, manifest=["v.i", "v.m"])
    assert points(run.expired()) == {point(m.EXPIRED_TOTAL, 0, partner="acme")}


def test_many_events_without_broadcasts(spark):
    """Two runs of two tenants, some sharing history, with every size check failing."""
    rows = [dict(r, table_ref=t) for t in ("t.un", "t.ok", "u.un", "u.ok")
            for r in entity_rows([("b1", "1"), ("b2", "2")], [], []) if r["table_ref"] == "t.ok"]
    rows += entity_rows([], [], [("x", "1", 10), ("y", "9", 40)])
    other = {**FOUR, "processable_claims_input_table": "u.ok",
             "unprocessable_claims_input_table": "u.un"}
    events = [approval(**FOUR), approval(**FOUR),
              event("pipesv2_approval", {"partner": "zeta", **other})]
    names = ["t.ok", "t.un", "u.ok", "u.un", "h.ok", "h.un"]
    runs = [evaluation(spark, tables(spark, rows), *events, manifest=names) for _ in range(2)]
    runs[1]._small = lambda roles, per_event: False
    for family in ("filtered_pre", "new_providers", "member_ratio"):
        found = [sorted((r.event_id, r.metric_name, r.value, sorted(r.labels.items()))
                        for r in getattr(run, family)().collect()) for run in runs]
        assert found[0] == found[1] and len({f[0] for f in found[0]}) == 3
        if family == "new_providers":
            assert {f[2] for f in found[0]} == {0.5}
