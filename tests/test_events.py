"""Decoding, routing, validation and outcomes of single events."""

import base64
import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from claimgauge.functions.expressions import parse_day, parse_instant
from claimgauge.operators import routing
from claimgauge.operators.routing import ROUTES, bindings, event_outcomes, failures, route_events
from claimgauge.sources.events import decode_events
from tests.helpers import event, raw_events


def b64(text: str | bytes) -> str:
    data = text.encode() if isinstance(text, str) else text
    return json.dumps({"message": {"data": base64.b64encode(data).decode()}})


GOOD = event("p", {}, wrapped=False)
DECODING = {
    "decoded": [
        GOOD, b64(GOOD), event("p", None), b64("[1]"), b64('"text"'),
        # odd characters inside base64 are skipped
        b64(GOOD).replace('"data": "', '"data": "-\\n!'),
        # white space around documents, padding that nothing needs, repeated keys
        "\n\t" + GOOD, b64("\n" + GOOD), "\n" + b64("\t" + GOOD),
        json.dumps({"message": {"data": "=" + base64.b64encode(GOOD.encode()).decode() + "==="}}),
        GOOD.replace("{", '{"payload": 1, ', 1),
        json.dumps({"message": {"data": ""}, **json.loads(GOOD)}),
        json.dumps({"message": {}, **json.loads(GOOD)}),
        '{"payload": null, "source_timestamp": null}',
    ],
    "undecodable": [
        "", "not json", "{}", '{"payload": {}}', '{"source_timestamp": "x"}', b64("not json"),
        b64("null"), b64(b"\xff\xfe"), '{"message": {"data": "abc"}}', '{"message": {"data": "!!!!"}}',
    ],
    "broken": ['{"message": null}', '{"message": "x"}', '{"message": {"data": 5}}', "[1]"],
}


def test_decoding(spark):
    cases = [(kind, text) for kind, texts in DECODING.items() for text in texts]
    rows = decode_events(raw_events(spark, *[text for _, text in cases])).select(
        "event_id", "decoding").collect()
    found = {r.event_id: r.decoding for r in rows}
    for i, (kind, text) in enumerate(cases):
        assert found[f"e{i}"] == kind, text


def handlers_of(spark, text):
    return {r.handler for r in bindings(route_events(decode_events(raw_events(spark, text)))
                                        ).select("handler").collect()}


@pytest.mark.parametrize("pipeline,count", [
    ("pipesv2_approval", 10), ("pipesv2_wrangling", 7), ("pipesv2_submission", 5),
    ("pipesv2_selection", 2), ("pipesv2_evaluation", 2), ("pipesv2_release", 2), ("other", 1)])
def test_fan_out(spark, pipeline, count):
    found = handlers_of(spark, event(pipeline, {}))
    assert len(found) == count
    assert found - {"run_count"} == {r.handler for r in ROUTES if r.pipeline == pipeline}
    assert handlers_of(spark, event(pipeline, {}, status="RUNNING")) == {"run_count"}


def test_twenty_three_handlers():
    assert len({r.handler for r in ROUTES} | {routing.RUN_COUNT_HANDLER}) == 23


def all_variables(pipeline: str, **more) -> dict:
    variables: dict = {"partner": "acme", "submission_run_id": "r"}
    for route in ROUTES:
        if route.pipeline == pipeline:
            for role in route.roles:
                outer, _, inner = role.variable.partition(".")
                if inner:
                    variables.setdefault(outer, {})[inner] = "t"
                else:
                    variables.setdefault(outer, "t")
    return {**variables, **more}


def outcome(spark, text):
    routed = route_events(decode_events(raw_events(spark, text)))
    row = event_outcomes(routed).first()
    failed = {(r.stage, r.handler, r.error) for r in failures(routed).collect()}
    return row.outcome, row.code, failed


APPROVAL = "pipesv2_approval"


def test_good_events(spark):
    for pipeline in {r.pipeline for r in ROUTES}:
        assert outcome(spark, event(pipeline, all_variables(pipeline))) == ("ok", 204, set())
    # a base64 event without a source time matches nothing unless its pipeline does
    bare = b64(json.dumps({"payload": {"pipeline_uuid": "x", "status": "RUNNING"}}))
    assert outcome(spark, bare) == ("unmatched", 204, set())
    # the run count needs neither partner nor variables
    no_variables = json.loads(event("x", {}, wrapped=False))
    del no_variables["payload"]["variables"]
    assert outcome(spark, json.dumps(no_variables)) == ("ok", 204, set())


@pytest.mark.parametrize("value", [None, "", 0, False, [], {}])
def test_missing_variables_are_refused(spark, value):
    variables = all_variables("pipesv2_evaluation", partner=value)
    assert outcome(spark, event("pipesv2_evaluation", variables)) == (
        "bad_request", 400, {("handle", "savings/evaluation", "bad_request")})


def test_text_that_looks_empty_is_given(spark):
    variables = all_variables("pipesv2_evaluation", partner="0")
    assert outcome(spark, event("pipesv2_evaluation", variables))[0] == "ok"


def test_order_of_checks(spark):
    no_partner = all_variables(APPROVAL, partner=None)
    kind, code, failed = outcome(spark, event(APPROVAL, no_partner, when="yesterday"))
    assert (kind, code) == ("bad_request", 400)
    # the entity metrics look at the time before the partner
    assert ("handle", "new_members/approval", "internal_error") in failed
    assert ("handle", "savings/approval", "bad_request") in failed
    assert ("handle", "run_count", "internal_error") in failed


def test_bad_times(spark):
    for when in ("yesterday", "2024", "2024-1-5", ""):
        kind, code, failed = outcome(spark, event("x", {}, when=when or " "))
        assert (kind, code) == ("internal_error", 500), when
        assert failed == {("handle", "run_count", "internal_error")}


def test_null_variables_fail_every_handler(spark):
    kind, code, failed = outcome(spark, event("pipesv2_release", None))
    assert (kind, code) == ("internal_error", 500)
    assert failed == {("handle", "run_count", "internal_error"),
                      ("handle", "expired", "internal_error")}


def test_nested_variables(spark):
    release = "pipesv2_release"
    null_parent = all_variables(release, internal_validation=None)
    assert ("handle", "expired", "internal_error") in outcome(spark, event(release, null_parent))[2]
    no_parent = all_variables(release)
    del no_parent["manual_validation"]
    assert ("handle", "expired", "bad_request") in outcome(spark, event(release, no_parent))[2]


def payload_event(payload) -> str:
    return json.dumps({"source_timestamp": "2024-01-15T10:30:00Z", "payload": payload})


def test_null_payload_fails_some_matches(spark):
    kind, code, failed = outcome(spark, payload_event(None))
    assert (kind, code) == ("match_error", 500)
    strict = {r.handler for r in ROUTES if r.fails_on_no_payload}
    assert len(strict) == 10
    assert failed == {("match", h, "match_error") for h in strict | {"run_count"}}


def test_odd_payloads(spark):
    every, strict = {r.handler for r in ROUTES}, {r.handler for r in ROUTES
                                                  if r.fails_on_no_payload}
    for payload, expected in (("text", every), ([1], every), (5, every | {"run_count"}),
                              ([], strict), ("", strict), (0, strict | {"run_count"})):
        failed = {h for _, h, _ in outcome(spark, payload_event(payload))[2]}
        assert failed == expected, payload
    assert outcome(spark, payload_event({}))[0] == "unmatched"


def test_undecodable_and_broken(spark):
    assert outcome(spark, "nope") == ("undecodable", 400, set())
    assert outcome(spark, '{"message": null}') == ("internal_error", 500, set())


def test_times_as_senders_write_them(spark):
    """Standard-library parsing is the measure."""
    texts = ["2024-01-01", "20240101", "2024-W01-1", "2024W017", "2020-W53-5", "2024-W53-1",
             "2024-01-14T23:30:00-03:00", "20240101T000000Z", "2024-01-01 1:2:3", "2024-01-01T10",
             "2024-01-01T00:00:00 Europe/Paris", "2024-01-01T10:30:05,1234567", "2024-01-01T103005",
             "2024-13-01", "2024-02-30T00:00:00Z", "x", "", "2024-01-01T10:30:05+0530"]

    def plain(text):
        try:
            found = datetime.fromisoformat(text)
        except ValueError:
            return None, None
        return found.replace(tzinfo=found.tzinfo or UTC).timestamp(), found.date()

    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    instant = parse_instant(F.col("t"))
    got = frame.select((F.unix_micros(instant) / 1e6).alias("at"),
                       F.when(instant.isNotNull(), parse_day(F.col("t"))).alias("day")).collect()
    assert [tuple(r) for r in got] == [plain(t) for t in texts]


def test_days_are_counted_in_the_offset_of_the_event(spark):
    late = event(routing.APPROVAL, {}, when="2024-01-14T23:30:00-03:00")
    row = route_events(decode_events(raw_events(spark, late))).first()
    assert row["as_of_day"] == date(2024, 1, 14)


def test_the_first_handler_asked_names_the_refusal(spark):
    """With both input tables of the first handler, the second finds its own missing."""
    some = event(routing.APPROVAL, {
        "partner": "acme", "unprocessable_claims_input_table": "t.un",
        "processable_claims_input_table": "t.ok"})
    row = event_outcomes(route_events(decode_events(raw_events(spark, some)))).first()
    assert (row["outcome"], row["code"]) == ("bad_request", 400)
    assert "excluded_savings_input_table" in row["reason"]
