"""Run events derived from the ``events`` test table, and the tables they name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.operators.routing import (
    APPROVAL,
    EVALUATION,
    RELEASE,
    ROUTES,
    SELECTION,
    SUBMISSION,
    WRANGLING,
)
from claimgauge.plans.evaluate import Tables
from claimgauge.schemas import COMPLETED
from claimgauge.session import scratch_dir, scratch_scope, settled
from claimgauge.sources import standin
from claimgauge.sources.standin import table
from claimgauge.sources.store import SHAPES, TableStore

# The namespace of tables that events name without one.
NAMESPACE = "default"
PIPELINES = [APPROVAL, WRANGLING, SELECTION, EVALUATION, SUBMISSION, RELEASE, "other_pipeline"]
STATUSES = {"purchase": COMPLETED, "view": COMPLETED, "click": "RUNNING", "signup": "INITIAL",
            "error": "FAILED"}
# Variables one in thirteen noisy events lacks.
DROPPED = ["unprocessable_claims_input_table", "refined_unprocessable_claims_output_table",
           "savings_input_table", "manual_validation_output_table",
           "manual_validation.manual_validation_claims_input_table"]
# Days from the run events (January 2024) back to June 2001, where claims are.
SHIFT_DAYS = 8249


def _variables(pipelines: list[str], ref: Callable[[str, str], Column],
               **more: Column) -> Column:
    """The payload variables that the routes of some pipelines read, as a struct."""
    flat: dict[str, Column] = dict(more)
    nested: dict[str, list[Column]] = {}
    for route in ROUTES:
        if route.pipeline not in pipelines:
            continue
        for role in route.roles:
            outer, _, inner = role.variable.partition(".")
            value = ref(role.name, role.variable)
            if not inner:
                flat.setdefault(outer, value)
            else:
                nested.setdefault(outer, []).append(value.alias(inner))
    columns = [c.alias(n) for n, c in flat.items()]
    columns += [F.struct(*cs).alias(n) for n, cs in nested.items()]
    return F.struct(*columns)


def _by(number: Column, divisor: int) -> Column:
    return number % divisor == 0


def noisy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the test table is one small file, and the work is in making and parsing the texts
    events = table(spark, sf_dir, "events")
    return as_noisy_events(events.repartition(spark.sparkContext.defaultParallelism, "event_id"))


def as_noisy_events(events: DataFrame) -> DataFrame:
    """Every row of ``events`` as a raw run event. Fixed shares of them are base64
    wrapped, cut short, or lack or break a part (see the conditions). Some are written in
    forms that readers have to bear: times of another offset or without separators, base64
    with line ends and needless padding, a key given twice."""
    n = F.col("event_id")
    pipeline = F.element_at(F.array(*[F.lit(p) for p in PIPELINES]), (n % 7 + 1).cast("int"))
    status = F.create_map(*[F.lit(x) for kv in STATUSES.items() for x in kv])[F.col("event_type")]

    def ref(role: str, variable: str) -> Column:
        name = F.concat(F.lit(f"tmp.{role}_"), (n % 5).cast("string"))
        return F.when(~_by(n, 13), name) if variable in DROPPED else name

    partner = F.when(~_by(n, 11), F.concat(F.lit("p"), (F.col("user_id") % 10).cast("string")))
    variables = _variables(PIPELINES, ref, partner=partner, submission_run_id=F.lit("r1"),
                           props=F.col("props"))
    variables_json = F.when(_by(n, 17), F.lit("null")).otherwise(F.to_json(variables))
    twice = F.when(_by(n, 6), F.lit('"status":"UNKNOWN",')).otherwise("")
    payload = F.when(_by(n, 19), F.lit("null")).otherwise(F.concat(
        F.lit('{"id":'), n.cast("string"), F.lit(","), twice, F.lit('"pipeline_uuid":"'), pipeline,
        F.lit('","status":"'), status, F.lit('","variables":'), variables_json, F.lit("}")))
    ahead = F.col("ts") + F.make_dt_interval(hours=F.lit(5), mins=F.lit(30))
    iso = (F.when(_by(n, 5), F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))
           .when(_by(n, 9), F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS'Z'"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    stamp = F.when(_by(n, 23), F.lit("not a time")).otherwise(iso)
    time = F.when(_by(n, 29), F.lit("")).otherwise(
        F.concat(F.lit('"source_timestamp":"'), stamp, F.lit('",')))
    document = F.concat(F.lit("{"), time, F.lit('"object":"run","payload":'), payload, F.lit("}"))
    encoded = F.base64(F.encode(document, "UTF-8"))
    inner = F.when(_by(n, 31), F.expr("substring(_encoded, 1, length(_encoded) - 1)")).otherwise(
        F.col("_encoded"))
    loose = F.concat(F.substring(inner, 1, 40), F.lit("\\n"), F.expr("substring(_encoded, 41)"),
                     F.when(_by(n, 8), "==").otherwise(""))
    inner = F.when(_by(n, 4) & ~_by(n, 31), loose).otherwise(inner)
    wrapped = F.concat(F.lit('{"message":{"data":"'), inner, F.lit('","messageId":"m"}}'))
    bare = F.when(_by(n, 31), F.expr("substring(_document, 1, length(_document) - 1)")).otherwise(
        F.col("_document"))
    raw = F.when(_by(n, 37), F.lit('{"message":null}')).when(_by(n, 2), wrapped).otherwise(bare)
    rows = events.withColumn("_document", document).withColumn(
        "_encoded", F.regexp_replace(encoded, r"\s", ""))
    return rows.select(n.cast("string").alias("event_id"), raw.alias("raw"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # as for noisy_events
    events = table(spark, sf_dir, "events").repartition(
        spark.sparkContext.defaultParallelism, "event_id")
    return as_run_events(events, table(spark, sf_dir, "region"))


def _namespace(day: Column) -> Column:
    """Where the batch tables of a day of the month are: events name those of even days
    without a namespace."""
    return F.when(day % 2 == 0, F.lit(f"{NAMESPACE}.")).otherwise(F.lit("tmp."))


def as_run_events(events: DataFrame, region: DataFrame) -> DataFrame:
    """Every row of ``events`` as the raw event of a completed run of one of the pipelines,
    moved to June 2001 and naming the tables of :func:`publish_run_tables`."""
    runs = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("user_id") % 5).cast("int").alias("r_regionkey"),
        F.date_sub(F.to_date("ts"), SHIFT_DAYS).alias("day"),
        (F.col("event_id") % len(PIPELINES)).cast("int").alias("which")).join(region, "r_regionkey")
    day = F.dayofmonth("day")

    def ref(role: str, variable: str) -> Column:
        partner = F.col("r_name")
        if role.endswith("_validation"):
            return F.concat(F.lit(f"val.{role}_"), partner)
        if role == "submitted" or "historical" in variable or role.startswith("history_"):
            return F.concat(F.lit(f"hist.{role.removeprefix('history_')}_"), partner)
        return F.concat(F.when(day % 2 == 0, "").otherwise("tmp."), F.lit(f"{role}_"), partner,
                        F.lit("_"), day.cast("string"))

    quarter = day % 26
    run_id = ((F.lit(1995) + F.floor(quarter / 4)) * 10 + quarter % 4 + 1).cast("string")
    variables = F.to_json(_variables(PIPELINES, ref, partner=F.col("r_name"),
                                     submission_run_id=run_id))
    pipeline = F.element_at(F.array(*[F.lit(p) for p in PIPELINES]), F.col("which") + 1)
    # the same instant, written in the offset of the partner: there it is the day before
    before = F.col("r_name") == "AMERICA"
    stamp = F.concat(F.date_format(F.date_sub("day", F.when(before, 1).otherwise(0)), "yyyy-MM-dd"),
                     F.when(before, "T19:10:00-05:00").otherwise("T00:10:00Z"))
    raw = F.concat(F.lit('{"source_timestamp":"'), stamp,
                   F.lit('","payload":{"pipeline_uuid":"'), pipeline,
                   F.lit(f'","status":"{COMPLETED}","variables":'), variables, F.lit("}}"))
    return runs.select("event_id", raw.alias("raw"))


# The tables each pipeline's metrics read.
READS = {
    APPROVAL: ("claims", "savings"), WRANGLING: ("claims",), SELECTION: ("savings",),
    EVALUATION: ("savings",), SUBMISSION: ("claims", "savings", "validation", "submitted"),
    RELEASE: ("validation",),
}


def publish_run_tables(spark: SparkSession, sf_dir: str, shapes: Iterable[str],
                       gaps: bool = False) -> tuple[Tables, DataFrame]:
    """The stand-in claims published under their names in a store of its own, and the
    manifest. With ``gaps`` some tables are empty and some are retired (see :func:`gap_of`);
    else the tables are those that have rows."""
    rows = standin.claims(spark, sf_dir, partner=True, agent=True)
    views = {shape: _run_view(rows, shape) for shape in VIEW_COLUMNS}
    kept = {name: T.StructType([f for f in rows.schema.fields if f.name in SHAPES[name].names])
            for name, rows in views.items()}
    store = TableStore(spark, scratch_dir(spark, "run-tables"), kept)
    shapes = list(shapes)
    used = dict.fromkeys(c for shape in shapes for c in VIEW_COLUMNS[shape])
    with scratch_scope(spark):  # the tables are joined once for all shapes
        rows = settled(rows.select(*used), "claims")
        for shape in shapes:
            view = _run_view(rows, shape)
            if not gaps:
                store.publish(shape, view)
                continue
            names = table_names(spark, sf_dir).where(F.col("shape") == shape)
            filled = names.where(F.col("gap").isNull())
            store.publish(shape, view.join(F.broadcast(filled.select("table_ref")), "table_ref", "left_semi"),
                          names.select("table_ref"))
            store.retire(shape, names.where(F.col("gap") == "missing").select("table_ref"))
    return Tables(**{name: store.rows(name) for name in views}), store.manifest()


# Batch roles with their shape, in the order that decides which days they have gaps on.
BATCH_ROLES = {"unprocessable": "claims", "processable": "claims", "excluded": "savings",
               "savings": "savings", "selected": "savings"}
# Tables per partner with their shape, and the partners they are missing or empty for.
PARTNER_TABLES = {
    "hist.processable": ("claims", {"AFRICA": "missing", "EUROPE": "empty"}),
    "hist.unprocessable": ("claims", {"ASIA": "missing", "EUROPE": "empty"}),
    "hist.selected": ("savings", {"AMERICA": "missing"}),
    "hist.submitted": ("submitted", {"MIDDLE EAST": "missing"}),
    "val.internal_validation": ("validation", {"ASIA": "missing"}),
    "val.manual_validation": ("validation", {"EUROPE": "empty"}),
}


def gap_of(place: int, day: Column) -> Column:
    """What a batch role has on a day of the month: a role is missing on the days whose
    remainder by seven is its place in ``BATCH_ROLES``, and empty four days on."""
    return F.when(day % 7 == place, "missing").when(day % 7 == (place + 4) % 7, "empty")


def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables that there could be: ``table_ref``, ``shape``, ``gap`` (null: has its rows)."""
    partners = table(spark, sf_dir, "region").select(F.col("r_name").alias("partner"))
    days = partners.select("partner", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("day"))
    batches = days.select(F.inline(F.array(*[F.struct(
        F.concat(_namespace(F.col("day")), F.lit(f"{role}_"), "partner", F.lit("_"),
                 F.col("day").cast("string")).alias("table_ref"),
        F.lit(shape).alias("shape"), gap_of(place, F.col("day")).alias("gap"))
        for place, (role, shape) in enumerate(BATCH_ROLES.items())])))

    def gap(by_partner: dict[str, str]) -> Column:
        found = F.lit(None).cast("string")
        for partner, kind in by_partner.items():
            found = F.when(F.col("partner") == partner, kind).otherwise(found)
        return found

    others = partners.select(F.inline(F.array(*[F.struct(
        F.concat(F.lit(f"{name}_"), "partner").alias("table_ref"), F.lit(shape).alias("shape"),
        gap(by_partner).alias("gap")) for name, (shape, by_partner) in PARTNER_TABLES.items()])))
    return batches.unionByName(others)


# The columns of claims that each view is made of.
VIEW_COLUMNS = {
    "claims": ("item_id", "invoice_id", "provider_id", "member_id", "paid_value", "reported_value",
               "created_at", "ingested_at", "processable", "partner"),
    "savings": ("item_id", "agent_id", "saving_value", "created_at", "ingested_at", "l_suppkey",
                "l_returnflag", "partner"),
    "validation": ("item_id", "invoice_id", "saving_value", "ingested_at", "updated_at",
                   "processable", "l_linenumber", "l_suppkey", "l_returnflag", "partner"),
    "submitted": ("item_id", "saving_value", "created_at", "ingested_at", "l_tax", "order_id",
                  "o_orderstatus", "partner"),
}


def _run_view(rows: DataFrame, shape: str) -> DataFrame:
    """Batches by day of the month; histories, validation and submissions by partner."""
    rows = rows.withColumns({c: F.col(c).cast("timestamp") for c in ("ingested_at", "created_at")
                             if c in rows.columns})
    partner, day = F.col("partner"), F.dayofmonth("created_at")
    side = F.when(F.col("processable"), "processable").otherwise("unprocessable")

    def tagged(frame: DataFrame, *refs: Column) -> DataFrame:
        return frame.withColumn("table_ref", F.explode(F.array_compact(F.array(*refs))))

    def batch(role: str | Column) -> Column:
        name = F.lit(role) if isinstance(role, str) else role
        return F.concat(_namespace(day), name, F.lit("_"), partner, F.lit("_"), day.cast("string"))

    def history(role: str | Column) -> Column:
        name = F.lit(role) if isinstance(role, str) else role
        return F.concat(F.lit("hist."), name, F.lit("_"), partner)

    if shape == "claims":
        return tagged(rows, batch(side), history(side))
    if shape == "savings":
        chosen = F.col("l_suppkey") % 3 == 0
        return tagged(
            rows, batch("savings"), F.when(F.col("l_returnflag") == "R", batch("excluded")),
            F.when(chosen, batch("selected")), F.when(chosen, history("selected")))
    if shape == "validation":
        kind = F.when(F.col("processable"), "internal").otherwise("manual")
        return standin.validation(rows).withColumn(
            "table_ref", F.concat(F.lit("val."), kind, F.lit("_validation_"), partner))
    return standin.submitted(rows).withColumn("table_ref", history("submitted"))
