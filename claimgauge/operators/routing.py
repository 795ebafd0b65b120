"""Routing of decoded events to metrics, validation, and outcomes.

An event stays one row: its matched routes are an array in it, so outcomes need no
shuffle. ``bindings`` then gives one row per event and route for the metrics.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.functions.expressions import parse_day, parse_instant
from claimgauge.functions.variants import (
    DOUBTFUL_TEXT,
    as_text,
    get,
    given_text,
    is_missing,
    is_object,
    once,
    text_at,
)
from claimgauge.schemas import COMPLETED
from claimgauge.session import settled
from claimgauge.sources.events import DECODED, UNDECODABLE

# What a missing table does to a route (besides being counted as empty).
TOLERATE, BAD_REQUEST, INTERNAL_ERROR = "tolerate", "bad_request", "internal_error"

# Checks that are not payload variables; failing one is an internal error.
TIME = "@source_timestamp"
SHAPE = "@variables"
PARENTS = "@nested_variables"


@dataclass(frozen=True)
class Role:
    """A table a route reads: our name for it, the payload variable naming it, and
    what happens when there is no such table."""

    name: str
    variable: str
    on_missing: str = TOLERATE


@dataclass(frozen=True)
class Route:
    handler: str
    pipeline: str
    metric: str
    roles: tuple[Role, ...]
    approved: str | None = None
    # what must be there besides the tables, in the order it is looked at
    then: tuple[str, ...] = ("partner", TIME)
    # checked before the tables
    before: tuple[str, ...] = ()
    # whether a payload that is null or empty fails the match (else: no match)
    fails_on_no_payload: bool = False

    @property
    def checks(self) -> list[str]:
        return [SHAPE, *self.before, *[r.variable for r in self.roles], *self.then]


@dataclass(frozen=True)
class _Names:
    """Payload variables of the claim tables of one pipeline."""

    pipeline: str
    approved: str
    unprocessable: str
    processable: str
    history_unprocessable: str
    history_processable: str
    fails_on_no_payload: bool
    suffix: str


# ---- fixed values: pipelines, payload variables ------------------------------------
APPROVAL, WRANGLING, SELECTION = "pipesv2_approval", "pipesv2_wrangling", "pipesv2_selection"
EVALUATION, SUBMISSION, RELEASE = "pipesv2_evaluation", "pipesv2_submission", "pipesv2_release"

_CLAIM_TABLES = (
    _Names(APPROVAL, "true", "unprocessable_claims_input_table", "processable_claims_input_table",
           "unprocessable_claims_output_table", "processable_claims_output_table", True, "approval"),
    _Names(WRANGLING, "false", "refined_unprocessable_claims_output_table",
           "refined_processable_claims_output_table",
           "refined_unprocessable_claims_historical_table",
           "refined_processable_claims_historical_table", False, "wrangling"),
)
_VALIDATION = (
    Role("internal_validation", "internal_validation_output_table", INTERNAL_ERROR),
    Role("manual_validation", "manual_validation_output_table", INTERNAL_ERROR),
)
_SENT = Role("submitted", "claims_submitted_output_table", INTERNAL_ERROR)
_SUBMISSION_THEN = ("partner", "submission_run_id", TIME)

RUN_COUNT_HANDLER = "run_count"


def _claim_routes(names: _Names) -> list[Route]:
    part = Role("unprocessable", names.unprocessable)
    rest = Role("processable", names.processable)
    batch = (Role("processable", names.processable, BAD_REQUEST),
             Role("unprocessable", names.unprocessable, BAD_REQUEST))
    history = (Role("history_processable", names.history_processable),
               Role("history_unprocessable", names.history_unprocessable))

    def route(metric: str, roles: tuple[Role, ...], **extra) -> Route:
        return Route(f"{metric}/{names.suffix}", names.pipeline, metric, roles, names.approved,
                     fails_on_no_payload=names.fails_on_no_payload, **extra)

    routes = [route("filtered_pre", (part, rest)), route("processable", (rest, part))]
    for metric in ("new_providers", "new_members", "provider_ratio", "member_ratio"):
        routes.append(route(metric, batch + history, then=(TIME, "partner")))
    return routes


def _submission(metric: str, *roles: Role) -> Route:
    return Route(metric, SUBMISSION, metric, roles, then=_SUBMISSION_THEN)


# The order in which handlers are asked; the first refusal is the reply.
_ASKED = ("filtered_pre", "filtered_post", "processable", "selected_savings", "savings",
          "new_providers", "new_members", "sent_over_received", "sent_over_validation",
          "shared_invoice", "sent_over_accepted", "expired", "provider_ratio", "member_ratio")

ROUTES: list[Route] = sorted([
    *[route for names in _CLAIM_TABLES for route in _claim_routes(names)],
    Route("filtered_post/selection", SELECTION, "filtered_post",
          (Role("excluded", "excluded_savings_output_table"),
           Role("savings", "savings_input_table", INTERNAL_ERROR)), "false"),
    Route("filtered_post/approval", APPROVAL, "filtered_post",
          (Role("excluded", "excluded_savings_input_table"),
           Role("savings", "savings_input_table", INTERNAL_ERROR)), "true",
          fails_on_no_payload=True),
    Route("selected_savings/approval", APPROVAL, "selected_savings",
          (Role("selected", "selected_savings_input_table"),), fails_on_no_payload=True),
    Route("savings/evaluation", EVALUATION, "savings", (Role("savings", "savings_output_table"),),
          "false", fails_on_no_payload=True),
    Route("savings/approval", APPROVAL, "savings", (Role("savings", "savings_input_table"),),
          "true", fails_on_no_payload=True),
    _submission("sent_over_received",
                Role("processable", "processable_claims_historical_table", INTERNAL_ERROR),
                Role("unprocessable", "unprocessable_claims_historical_table", INTERNAL_ERROR),
                *_VALIDATION, _SENT),
    _submission("sent_over_validation", *_VALIDATION, _SENT),
    _submission("shared_invoice", *_VALIDATION, _SENT),
    _submission("sent_over_accepted",
                Role("selected", "selected_savings_historical_table", INTERNAL_ERROR),
                *_VALIDATION, _SENT),
    Route("expired", RELEASE, "expired",
          (Role("internal_validation",
                "internal_validation.internal_validation_claims_input_table", INTERNAL_ERROR),
           Role("manual_validation",
                "manual_validation.manual_validation_claims_input_table", INTERNAL_ERROR)),
          before=(PARENTS, "partner"), then=(TIME,)),
], key=lambda route: _ASKED.index(route.metric))

_HANDLER = ("struct<handler:string,metric:string,approved:string,"
            "roles:array<struct<name:string,variable:string,on_missing:string>>,"
            "checks:array<string>>")


def _entry(route: Route) -> tuple:
    return (route.handler, route.metric, route.approved,
            [(r.name, r.variable, r.on_missing) for r in route.roles], route.checks)


def routes_frame(spark: SparkSession) -> DataFrame:
    """The routes as one row per (pipeline, status): a fixed handful of rows."""
    by_pipeline: dict[str, list[tuple]] = {}
    for route in ROUTES:
        by_pipeline.setdefault(route.pipeline, []).append(_entry(route))
    rows = [(pipeline, COMPLETED, handlers) for pipeline, handlers in by_pipeline.items()]
    return spark.createDataFrame(
        rows, f"pipeline_uuid string, status string, _routes array<{_HANDLER}>")


def _run_count_handler() -> Column:
    return F.from_json(F.lit(
        f'{{"handler":"{RUN_COUNT_HANDLER}","metric":"run_count","roles":[],'
        f'"checks":["{SHAPE}","{TIME}"]}}'), _HANDLER)


_VARIABLES = sorted({r.variable for route in ROUTES for r in route.roles}
                    | {"partner", "submission_run_id"})
_PARENT_NAMES = sorted({v.partition(".")[0] for v in _VARIABLES if "." in v})


def _pairs(read: Callable[[Column, str], Column]) -> Column:
    """(variable, text) of the payload variables any route reads."""
    return F.array(*[F.struct(F.lit(name).alias("key"),
                              read(F.col("_fields.variables"), f"$.{name}").alias("value"))
                     for name in _VARIABLES])


def _read_pairs(pairs: Column) -> Column:
    """``pairs`` with the texts that count as given. Only events with a doubtful text are read by
    type."""
    doubtful = F.exists(pairs, lambda p: p["value"].isin(DOUBTFUL_TEXT))
    return F.when(F.coalesce(doubtful, F.lit(False)), _pairs(given_text)).otherwise(pairs)


def _held() -> Column:
    """The checks that hold besides the variables, as pairs."""
    variables = F.col("_fields.variables")
    parents = [get(variables, f"$.{p}") for p in _PARENT_NAMES]
    parents_fit = ~reduce(lambda a, b: a | b,
                          [p.isNotNull() & ~is_object(p) for p in parents])
    shape_fits = variables.isNull() | is_object(variables)
    return F.array(*[F.struct(F.lit(check).alias("key"), F.when(holds, F.lit("")).alias("value"))
                     for check, holds in ((SHAPE, shape_fits), (PARENTS, parents_fit),
                                          (TIME, F.col("as_of").isNotNull()))])


def _given() -> Column:
    """What the event gives, as a map from check to text: its variables, and the other
    checks that hold."""
    return F.map_from_entries(F.filter(F.concat("_read", "_held"), lambda p: p["value"].isNotNull()))


def _handled(matched: Column) -> Column:
    """The matched handlers with their outcome: the first check not met decides."""
    checks_met = F.map_keys("_given")
    tried = F.transform(matched, lambda h: F.struct(
        h.alias("h"),
        F.try_element_at(F.array_except(h["checks"], checks_met), F.lit(1)).alias("first")))
    return F.transform(tried, lambda t: F.struct(
        t["h"]["handler"].alias("handler"), t["h"]["metric"].alias("metric"),
        t["h"]["approved"].alias("approved"),
        F.transform(t["h"]["roles"], lambda r: F.struct(
            r["name"].alias("role"),
            F.try_element_at(F.col("_given"), r["variable"]).alias("table_ref"),
            r["on_missing"].alias("on_missing"))).alias("refs"),
        F.when(t["first"].startswith("@"), INTERNAL_ERROR)
        .when(t["first"].isNotNull(), BAD_REQUEST).alias("error"),
        F.concat(F.lit("missing or malformed: "), t["first"]).alias("reason")))


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _read_events(decoded: DataFrame) -> DataFrame:
    """Add to decoded events their fields and ``match_errors`` (handlers that failed to match), and
    what decides on their handlers: ``_read`` and ``_held`` (see :func:`_given`), ``_counts``."""
    every = [r.handler for r in ROUTES]
    failing = [r.handler for r in ROUTES if r.fails_on_no_payload]
    doc = F.col("doc")
    payload = F.try_variant_get(
        doc, "$.payload", "struct<pipeline_uuid:variant,status:variant,variables:variant>")
    fields = (
        decoded.withColumn("_payload", get(doc, "$.payload"))
        .withColumn("_fields", payload)
        .withColumn("pipeline_uuid", as_text(F.col("_fields.pipeline_uuid")))
        .withColumn("status", as_text(F.col("_fields.status")))
        # a generator, so that the time is read once and not by each of its uses
        .select("*", F.inline(F.array(once(as_text(get(doc, "$.source_timestamp")), lambda stamp: once(
            parse_instant(stamp), lambda as_of: F.struct(
                as_of.alias("as_of"),
                F.when(as_of.isNotNull(), parse_day(stamp)).alias("as_of_day")))))))
        .withColumn("_pairs", _pairs(text_at))
        .withColumn("_read", _read_pairs(F.col("_pairs"))).withColumn("_held", _held())
    )
    given = F.col("_payload").isNotNull()
    holds_keys = F.col("_fields").isNotNull()
    has_time = get(doc, "$.source_timestamp").isNotNull()
    # a payload that cannot hold keys: null, a number or a boolean
    no_container = given & ~holds_keys & ~F.to_json("_payload").rlike(r'^["\[]')
    counts_runs = has_time & F.col("_fields.pipeline_uuid").isNotNull() & F.col(
        "_fields.status").isNotNull()
    no_errors = F.array().cast("array<string>")
    match_errors = (
        F.when(~F.col("doc_is_object"), _names(every))
        .when(~given | holds_keys, no_errors)
        .when(is_missing(F.col("_payload")), _names(failing)).otherwise(_names(every))
    )
    count_error = F.when(has_time & no_container, _names([RUN_COUNT_HANDLER])).otherwise(no_errors)
    usable = F.col("decoding") == DECODED
    return (
        fields.withColumn("match_errors", F.when(usable, F.concat(count_error, match_errors))
                          .otherwise(no_errors))
        .withColumn("_counts", usable & counts_runs)
        .drop("_payload", "_fields", "_pairs", "doc", "doc_is_object")
    )


def _with_handlers(read: DataFrame) -> DataFrame:
    """``handlers`` (those matched, each with its tables and outcome) of what events give."""
    no_handlers = F.array().cast(f"array<{_HANDLER}>")
    routes = F.broadcast(routes_frame(read.sparkSession))
    given = (
        read.withColumn("_given", _given())
        .withColumn("partner", F.try_element_at("_given", F.lit("partner")))
        .withColumn("submission_run_id", F.try_element_at("_given", F.lit("submission_run_id")))
    )
    return (
        given.join(routes, ["pipeline_uuid", "status"], "left")
        .withColumn("_matched", F.when(F.col("decoding") == DECODED, F.concat(
            F.when(F.col("_counts"), F.array(_run_count_handler())).otherwise(no_handlers),
            F.coalesce("_routes", no_handlers))).otherwise(no_handlers))
        .withColumn("handlers", _handled(F.col("_matched")))
        .drop("_read", "_held", "_counts", "_given", "_routes", "_matched")
    )


def route_events(decoded: DataFrame) -> DataFrame:
    """Add to decoded events their fields, ``match_errors`` (handlers that failed to
    match) and ``handlers`` (those matched, each with its tables and outcome)."""
    return _with_handlers(_read_events(decoded))


#: Pipelines with a metric that depends on the instant of an event and not only on its day.
_BY_INSTANT = (SUBMISSION, RELEASE)


def shared_asks(decoded: DataFrame, pipelines: Sequence[str] | None = None) -> DataFrame:
    """Decoded events with what they ask, written once: ``event_id``, ``ask``, ``as_of``,
    ``as_of_day``, ``decoding``, ``raw`` (if they could not be decoded) and ``asked``.

    Events that agree in all that decides on their metrics (variables, pipeline and status, day,
    and the instant where a metric depends on it) have one ``ask``, which is routed, checked and
    evaluated once (:func:`asks_of`). With ``pipelines`` the events of others are left out.
    """
    read = _read_events(decoded)
    if pipelines is not None:
        read = read.where(F.col("pipeline_uuid").isin(*pipelines))
    instant = F.when(F.col("pipeline_uuid").isin(*_BY_INSTANT), F.col("as_of"))
    asked = F.struct(*[F.col(c) for c in (
        "decoding", "pipeline_uuid", "status", "as_of_day", "match_errors", "_read", "_held",
        "_counts")], instant.alias("as_of"))
    raw = F.when(F.col("decoding") != DECODED, F.col("raw"))
    events = read.select("event_id", "as_of", "as_of_day", "decoding", raw.alias("raw"),
                         asked.alias("asked"))
    # JSON leaves out what is less than a millisecond
    whole = F.struct("asked", F.unix_micros("asked.as_of").alias("at"))
    return settled(events.withColumn("ask", F.md5(F.to_json(whole))), "asks")


def asks_of(events: DataFrame) -> DataFrame:
    """The distinct asks of :func:`shared_asks`, routed as by :func:`route_events`: each is a row
    with the ``ask`` for its ``event_id``. ``as_of`` is null where only the day counts."""
    asks = events.select(F.col("ask").alias("event_id"), "asked.*").distinct()
    return settled(_with_handlers(asks), "routed-asks")


def event_outcomes(routed: DataFrame) -> DataFrame:
    """The outcome of each event and the reply code that goes with it."""
    def any_with(kind: str) -> Column:
        return F.exists("handlers", lambda h: h["error"].eqNullSafe(F.lit(kind)))

    outcome = (
        F.when(F.col("decoding") == UNDECODABLE, "undecodable")
        .when(F.col("decoding") != DECODED, INTERNAL_ERROR)
        .when(F.size("match_errors") > 0, "match_error")
        .when(any_with(BAD_REQUEST), BAD_REQUEST)
        .when(any_with(INTERNAL_ERROR), INTERNAL_ERROR)
        .when(F.size("handlers") == 0, "unmatched").otherwise("ok")
    )
    code = (F.when(F.col("outcome").isin("undecodable", BAD_REQUEST), 400)
            .when(F.col("outcome").isin("ok", "unmatched"), 204).otherwise(500))
    first_refusal = F.try_element_at(
        F.filter("handlers", lambda h: h["error"] == BAD_REQUEST), F.lit(1))["reason"]
    return routed.select("event_id", outcome.alias("outcome"), first_refusal.alias("_refusal")
                         ).select("event_id", "outcome", code.alias("code"),
                                  F.when(F.col("outcome") == BAD_REQUEST, F.col("_refusal"))
                                  .alias("reason"))


def outcomes_of(events: DataFrame, checked: DataFrame) -> DataFrame:
    """:func:`event_outcomes` of the events of :func:`shared_asks`, of their ``checked`` asks."""
    of_asks = event_outcomes(checked).withColumnRenamed("event_id", "ask")
    return events.select("event_id", "ask").join(of_asks, "ask").drop("ask")


def failures(routed: DataFrame) -> DataFrame:
    """One row per failed handler of an event: at matching or at handling."""
    matching = F.transform("match_errors", lambda h: F.struct(
        F.lit("match").alias("stage"), h.alias("handler"), F.lit("match_error").alias("error"),
        F.lit("payload cannot be matched").alias("reason")))
    handling = F.transform(F.filter("handlers", lambda h: h["error"].isNotNull()),
                           lambda h: F.struct(F.lit("handle").alias("stage"), h["handler"],
                                              h["error"], h["reason"]))
    return routed.select("event_id", F.inline(F.concat(matching, handling)))


def bindings(routed: DataFrame) -> DataFrame:
    """One row per event and matched handler: the work list of the metrics."""
    return routed.select(
        "event_id", "pipeline_uuid", "status", "as_of", "as_of_day", "partner",
        "submission_run_id", F.inline("handlers"))


def qualify(table_ref: Column, default_namespace: str) -> Column:
    """Prefix the default namespace to names without a dot."""
    return F.when(table_ref.contains("."), table_ref).otherwise(
        F.concat(F.lit(default_namespace + "."), table_ref))


def check_tables(routed: DataFrame, manifest: DataFrame, default_namespace: str) -> DataFrame:
    """Qualify table names, mark which tables exist and apply the missing-table rules.

    ``manifest`` lists the existing tables (``table_ref``), and may say in which ``part`` of a
    store each lies; references are given that part. Only a reference's own (event, table)
    pairs are shuffled; the events come back by ``event_id``.
    """
    full = routed.withColumn("handlers", F.transform("handlers", lambda h: h.withField(
        "refs", F.transform(h["refs"], lambda r: r.withField(
            "table_ref", qualify(r["table_ref"], default_namespace))))))
    wanted = full.select("event_id", F.explode(F.array_distinct(F.flatten(F.transform(
        "handlers", lambda h: F.transform(h["refs"], lambda r: r["table_ref"]))))
    ).alias("table_ref"))
    part = F.col("part") if "part" in manifest.columns else F.lit("")
    listed = manifest.groupBy("table_ref").agg(F.max(part).alias("part"))
    found = wanted.join(listed, "table_ref")
    present = found.groupBy("event_id").agg(F.map_from_entries(F.collect_list(
        F.struct("table_ref", "part"))).alias("_present"))

    def applied(handler: Column) -> Column:
        at = F.transform(handler["refs"], lambda r: r.withField(
            "part", F.try_element_at("_present", r["table_ref"])))
        refs = F.transform(at, lambda r: r.withField("present", r["part"].isNotNull()))
        lost = F.filter(refs, lambda r: ~r["present"] & (r["on_missing"] != TOLERATE))
        first = F.try_element_at(lost, F.lit(1))
        return (handler.withField("refs", refs)
                .withField("error", F.coalesce(handler["error"], first["on_missing"]))
                .withField("reason", F.coalesce(handler["reason"], F.concat(
                    F.lit("table not found: "), first["table_ref"]))))

    return (
        full.join(present, "event_id", "left")
        .withColumn("_present", F.coalesce("_present", F.create_map().cast("map<string,string>")))
        .withColumn("handlers", F.transform("handlers", applied)).drop("_present")
    )
