"""From checked events to gauge points: every metric of every event at once.

Tables hold the rows of many source tables, told apart by ``table_ref``. Events name
the tables they are about; joining those names to ``table_ref`` gives each row its
event, or its set of tables where events share history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge import schemas as names
from claimgauge.functions.expressions import label_text
from claimgauge.operators import agents, entities, expiry, reconcile, shares
from claimgauge.operators.routing import RUN_COUNT_HANDLER, bindings, failures
from claimgauge.operators.joins import BROADCAST_BYTES, fits, linked
from claimgauge.operators.spine import Spine
from claimgauge.operators.windows import Windows, anchored_windows
from claimgauge.session import require_utc, settled
from claimgauge.sinks.metrics import to_points


@dataclass(frozen=True)
class Tables:
    """The data, in the shapes of ``claimgauge.schemas``."""

    claims: DataFrame
    savings: DataFrame
    validation: DataFrame
    submitted: DataFrame


_HISTORY = ["history_processable", "history_unprocessable"]
_VALIDATION = ["internal_validation", "manual_validation"]
_ENTITY_METRICS = ["new_providers", "new_members", "provider_ratio", "member_ratio"]
# Submission metrics and the items they are about.
_ITEMS = {"sent_over_received": "received", "sent_over_accepted": "accepted",
          "sent_over_validation": "analysed", "shared_invoice": "shared"}


def _ref(role: str) -> Column:
    return F.filter("refs", lambda r: r["role"] == role)[0]["table_ref"]


def _present(role: str) -> Column:
    return F.filter("refs", lambda r: r["role"] == role)[0]["present"]


def _set_of(*roles: str) -> Column:
    """A short name for the set of tables an event reads."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_ref(r), F.lit("")) for r in roles]))


def _named_by(rows: DataFrame) -> list[str]:
    """What tells the tables of a frame apart: their names, and in a store their parts, by
    which a scan is pruned."""
    return [c for c in ("part", "table_ref") if c in rows.columns]


class Evaluation:
    """Metrics of one batch of events. Each method gives the points of one family.

    The work list, an event-sized frame, is settled once in the scratch folder and the
    bytes of its links are summed per role: links of the roles a metric reads are broadcast
    within the bound, and salted beyond it, as one table may hold most rows.

    ``checked`` has a row per event; or, with ``events`` (see ``routing.shared_asks``), a row per
    ask of theirs. Then families give the points of asks, and :meth:`of_events` gives them to events.
    """

    def __init__(self, checked: DataFrame, tables: Tables, project: str,
                 events: DataFrame | None = None):
        spark = checked.sparkSession
        require_utc(spark)
        self.tables, self.project, self.events = tables, project, events
        self.routed = settled(checked, "routed")
        self.work = bindings(self.routed).where(F.col("error").isNull())
        refs = self.routed.select("event_id", F.explode(F.flatten(F.transform(
            "handlers", lambda h: h["refs"]))).alias("r"))
        named = refs.where(F.col("r.table_ref").isNotNull()).select(
            "event_id", F.col("r.role").alias("role"), F.col("r.table_ref").alias("ref")).distinct()
        long = F.octet_length("ref") + 64
        # a row per role comes back, a fixed handful
        self._bytes = {r["role"]: (r["links"], r["tables"]) for r in named.groupBy("role", "ref").agg(
            F.sum(F.octet_length("event_id") + long).alias("links")).groupBy("role").agg(
                F.sum("links").alias("links"), F.sum(long).alias("tables")).collect()}

    # ---- linking rows to events --------------------------------------------------

    def _of(self, *metrics: str) -> DataFrame:
        return self.work.where(F.col("metric").isin(*metrics))

    def _small(self, roles: Iterable[str], per_event: bool) -> bool:
        """Whether the links of events (or the names) of the tables in these roles may be
        broadcast."""
        sizes = [self._bytes.get(role, (0, 0))[0 if per_event else 1] for role in roles]
        return sum(sizes) <= BROADCAST_BYTES

    def _bind(self, rows: DataFrame, runs: DataFrame, key: str, roles: Iterable[str],
              columns: Iterable[str]) -> DataFrame:
        """Rows of the tables in the given roles, with the ``key`` of their runs."""
        on = _named_by(rows)
        links = runs.select(key, F.inline("refs")).where(F.col("role").isin(*roles)).select(
            key, "role", *on).distinct()
        return linked(rows.select(*on, *columns), links, on,
                      self._small(roles, True)).drop(*on, "role")

    def _per_table(self, rows: DataFrame, runs: DataFrame, roles: Iterable[str]) -> DataFrame:
        """Rows of the tables that any run names in these roles."""
        on = _named_by(rows)
        wanted = runs.select(F.inline("refs")).where(F.col("role").isin(*roles)).select(
            *on).distinct()
        return linked(rows, wanted, on, self._small(roles, False), "left_semi")

    def _points(self, frame: DataFrame, values: dict, **label_columns) -> DataFrame:
        return to_points(frame, values, {"partner": F.col("partner"), **label_columns},
                         self.project)

    # ---- families ----------------------------------------------------------------

    def run_count(self) -> DataFrame:
        runs = self.work.where(F.col("handler") == RUN_COUNT_HANDLER)
        return to_points(runs, {names.RUN_COUNT: F.lit(1.0)}, {
            "pipeline_uuid": F.col("pipeline_uuid"), "pipeline_status": F.col("status"),
            "partner": F.col("partner")}, self.project)

    def _shares(self, metric: str, rows: DataFrame, value: str, part: str, rest: str,
                denominator: str, emit: str, total_name: str, relative_name: str) -> DataFrame:
        """Each table is summed once, however many events name it."""
        runs = self._of(metric)
        sums = self._per_table(rows, runs, [part, rest]).groupBy("table_ref").agg(
            F.sum(value).alias("_sum"))
        sides = (
            runs.withColumn("_part_ref", _ref(part)).withColumn("_rest_ref", _ref(rest))
            .join(sums.select(F.col("table_ref").alias("_part_ref"),
                              F.col("_sum").alias("_part")), "_part_ref", "left")
            .join(sums.select(F.col("table_ref").alias("_rest_ref"),
                              F.col("_sum").alias("_rest")), "_rest_ref", "left")
        )
        done = sides.select("*", *shares.share_columns(
            F.col("_part"), F.col("_rest"), denominator, emit, _present(rest)))
        return self._points(done, {total_name: "total", relative_name: "relative"},
                            approved=F.col("approved"))

    def filtered_pre(self) -> DataFrame:
        return self._shares("filtered_pre", self.tables.claims, "paid_value", "unprocessable",
                            "processable", "sum", "if_rest_present", names.PRE_TOTAL,
                            names.PRE_RELATIVE)

    def processable(self) -> DataFrame:
        return self._shares("processable", self.tables.claims, "paid_value", "processable",
                            "unprocessable", "sum", "if_positive", names.PROCESSABLE_TOTAL,
                            names.PROCESSABLE_RELATIVE)

    def filtered_post(self) -> DataFrame:
        return self._shares("filtered_post", self.tables.savings, "saving_value", "excluded",
                            "savings", "rest", "always", names.POST_TOTAL, names.POST_RELATIVE)

    def savings(self) -> DataFrame:
        runs = self._of("savings")
        rows = self._per_table(self.tables.savings, runs, ["savings"])
        sums = agents.savings_by_agent(rows, ["table_ref"])
        done = runs.withColumn("table_ref", _ref("savings")).join(sums, "table_ref")
        return self._points(done, {names.SAVINGS_VALUE: "total_saving",
                                   names.SAVINGS_COUNT: "row_count"},
                            agent_id=label_text(F.col("agent_id")), approved=F.col("approved"))

    def selected_savings(self) -> DataFrame:
        runs = self._of("selected_savings")
        rows = self._per_table(self.tables.savings, runs, ["selected"])
        sums = agents.selected_savings_by_agent(rows, ["table_ref"])
        done = runs.withColumn("table_ref", _ref("selected")).join(sums, "table_ref")
        return self._points(done, {names.SELECTED_VALUE: "total_saving"},
                            agent_id=label_text(F.col("agent_id")), source="selected_savings")

    @cached_property
    def _asked(self) -> DataFrame:
        """Events whose batch is compared with history, each with its question: the tables it
        names and its day. Events that ask the same share one answer."""
        roles = ["processable", "unprocessable", *_HISTORY]
        runs = self._of(*_ENTITY_METRICS).where(_present(_HISTORY[0]) & _present(_HISTORY[1]))
        question = F.md5(F.concat_ws("|", F.col("as_of_day").cast("string"), *[
            F.coalesce(_ref(r), F.lit("")) for r in roles]))
        return runs.withColumn("question", question)

    @cached_property
    def _compared(self) -> DataFrame:
        """The distinct questions, once for all four metrics."""
        return self._asked.select("question", "as_of_day", "refs",
                                  _set_of(*_HISTORY).alias("history_set")).distinct()

    @cached_property
    def _entity_spine(self) -> Spine:
        return Spine.of(self._compared.drop("refs"), ["question"], ["history_set"],
                        "as_of_day", "as_of_day")

    @cached_property
    def _items_fit(self) -> bool:
        """Whether the items of all batches may be broadcast, asked once."""
        items = self._bind(self.tables.claims, self._compared, "history_set",
                           ["processable", "unprocessable"], ["item_id"])
        return fits(items.where(F.col("item_id").isNotNull()).distinct())

    def _entities(self, metric: str, operator, entity: str, value: str, name: str,
                  **more) -> DataFrame:
        """Events with both history tables are compared; without, all counts as new."""
        claims, compared = self.tables.claims, self._compared
        batch = self._bind(claims, compared, "question", ["processable", "unprocessable"],
                           ["item_id", entity])
        past = self._bind(claims, compared, "history_set", _HISTORY,
                          ["item_id", entity, "created_at"])
        found = operator(self._entity_spine, batch, past, entity, **more).select("question", value)
        events = self._asked.where(F.col("metric") == metric).join(found, "question", "left")
        alone = self._of(metric).where(~(_present(_HISTORY[0]) & _present(_HISTORY[1])))
        done = events.drop("question").unionByName(alone.withColumn(value, F.lit(1.0)))
        return self._points(done, {name: value}, approved=F.col("approved"))

    def new_providers(self) -> DataFrame:
        return self._entities("new_providers", entities.new_entity_pct_by_run, "provider_id",
                              "new_pct", names.NEW_PROVIDERS, items_fit=self._items_fit)

    def new_members(self) -> DataFrame:
        return self._entities("new_members", entities.new_entity_pct_by_run, "member_id",
                              "new_pct", names.NEW_MEMBERS, items_fit=self._items_fit)

    def provider_ratio(self) -> DataFrame:
        return self._entities("provider_ratio", entities.volume_ratio_by_run, "provider_id",
                              "ratio", names.PROVIDER_RATIO)

    def member_ratio(self) -> DataFrame:
        return self._entities("member_ratio", entities.volume_ratio_by_run, "member_id",
                              "ratio", names.MEMBER_RATIO)

    # ---- submission --------------------------------------------------------------

    @cached_property
    def _submissions(self) -> DataFrame:
        """Submission events with all tables their metrics read, as one set, and their
        question: tables, submission run and time. Events that ask the same share one answer."""
        theirs = F.filter("handlers", lambda h: h["metric"].isin(list(_ITEMS))
                          & h["error"].isNull())
        refs = F.array_distinct(F.flatten(F.transform(theirs, lambda h: h["refs"])))
        runs = self.routed.where(F.size(theirs) > 0).select(
            "event_id", "as_of", "submission_run_id", refs.alias("refs"))
        runs = runs.withColumn("table_set", F.md5(F.to_json("refs")))
        return runs.withColumn("question", F.md5(F.concat_ws(
            "|", "table_set", "submission_run_id", F.col("as_of").cast("string"))))

    @cached_property
    def _windows(self) -> Windows:
        """The windows of the distinct questions, found once for all four metrics."""
        asked = self._submissions.select("question", "table_set", "submission_run_id", "as_of").distinct()
        spans = anchored_windows(asked, self._sent("submission_run_id", "ingested_at"),
                                 ["table_set", "submission_run_id"])
        return Windows.of(spans.select("question", "table_set", "lo", "hi"),
                          ["question", "table_set"], ["table_set"])

    def _set_rows(self, rows: DataFrame, roles: list[str], *columns: str) -> DataFrame:
        return self._bind(rows, self._submissions, "table_set", roles, columns)

    def _sent(self, *columns: str) -> DataFrame:
        return self._set_rows(self.tables.submitted, ["submitted"], *columns)

    def _checked(self, *columns: str) -> DataFrame:
        return self._set_rows(self.tables.validation, _VALIDATION, "item_id", "status",
                              "ingested_at", *columns)

    def _submission_points(self, metric: str, result: DataFrame, values: dict,
                           **label_columns) -> DataFrame:
        done = (self._of(metric).drop("status")
                .join(self._submissions.select("event_id", "question"), "event_id")
                .join(result.drop("table_set"), "question"))
        return self._points(done, values, **label_columns)

    def _items(self, kind: str) -> DataFrame:
        windows = self._windows
        if kind == "received":
            received = self._set_rows(self.tables.claims, ["processable", "unprocessable"],
                                      "item_id", "paid_value", "reported_value", "ingested_at")
            return reconcile.sendable_items(received, self._checked("invoice_id"), windows)
        if kind == "accepted":
            selected = self._set_rows(self.tables.savings, ["selected"], "item_id", "saving_value",
                                      "ingested_at")
            return reconcile.accepted_items(
                selected, self._checked("invoice_id", "saving_value"), windows)
        checked = self._checked("saving_value", "filtered_reason")
        if kind == "analysed":
            return reconcile.analysed_items(checked, windows)
        return reconcile.shared_items(checked, windows)

    def _reconciliation(self, *kinds: str) -> reconcile.Reconciliation:
        return reconcile.Reconciliation(
            self._windows, self._sent("item_id", "status", "saving_value"),
            **{kind: self._items(kind) for kind in kinds})

    @cached_property
    def _together(self) -> reconcile.Reconciliation | None:
        """The items of all submission metrics with work in one table, and one scan of the
        submissions for all of them; nothing if one of them cannot be had."""
        kinds = [kind for metric, kind in _ITEMS.items() if metric in self.wanted()]
        try:
            return self._reconciliation(*kinds)
        except Exception:  # noqa: BLE001 - each metric is then tried alone, and fails alone
            return None

    def _reconciled(self, kind: str) -> reconcile.Reconciliation:
        return self._together or self._reconciliation(kind)

    def sent_over_received(self) -> DataFrame:
        return self._submission_points("sent_over_received", self._reconciled("received").received(), {
            names.SENT_PAID: "paid_share", names.SENT_REPORTED: "reported_share",
        }, status=label_text(F.col("status")))

    def sent_over_accepted(self) -> DataFrame:
        return self._submission_points(
            "sent_over_accepted", self._reconciled("accepted").by_status("accepted"),
            {names.SENT_ACCEPTED: "share"}, status=label_text(F.col("status")))

    def sent_over_validation(self) -> DataFrame:
        return self._submission_points(
            "sent_over_validation", self._reconciled("analysed").by_status("analysed"),
            {names.SENT_VALIDATION: "share"}, status=label_text(F.col("status")))

    def shared_invoice(self) -> DataFrame:
        return self._submission_points(
            "shared_invoice", self._reconciled("shared").shared(), {names.SHARED_SENT: "share"})

    def expired(self) -> DataFrame:
        runs = self._of("expired").withColumn("table_set", F.md5(F.to_json("refs")))
        checked = self._bind(self.tables.validation, runs, "table_set", _VALIDATION,
                             ["status", "saving_value", "ingested_at", "updated_at"])
        on = ["table_set", "as_of"]
        result = expiry.expired_validation_total_by_run(
            runs.select(*on).distinct(), checked, on, ["table_set"])
        return self._points(runs.join(result, on), {names.EXPIRED_TOTAL: "expired_saving"})

    # ---- failures ----------------------------------------------------------------

    def failure_points(self) -> DataFrame:
        return failure_points(self.routed, self.project)

    FAMILIES = (
        "run_count", "filtered_pre", "processable", "filtered_post", "savings",
        "selected_savings", "new_providers", "new_members", "provider_ratio", "member_ratio",
        "sent_over_received", "sent_over_accepted", "sent_over_validation", "shared_invoice",
        "expired", "failure_points",
    )

    def wanted(self) -> list[str]:
        """Families that have work in this batch."""
        return list(self._wanted)

    @cached_property
    def _wanted(self) -> list[str]:
        """The metric names of the work list, a fixed handful, are read back once."""
        asked = {r[0] for r in self.work.select("metric").distinct().collect()}
        failed = self.routed.where(
            (F.size("match_errors") > 0)
            | F.exists("handlers", lambda h: h["error"].isNotNull())).limit(1).count()
        return [f for f in self.FAMILIES if f in asked or (f == "failure_points" and failed)]

    def all_points(self) -> DataFrame | None:
        """The points of all families with work, as one frame: one that fails fails all. Use
        :func:`write_families` to keep them apart."""
        frames = [getattr(self, family)() for family in self.wanted()]
        result = None
        for frame in frames:
            result = frame if result is None else result.unionByName(frame)
        return result if result is None else self.of_events(result)

    def of_events(self, points: DataFrame) -> DataFrame:
        """The points of asks, given to each event that asks so; points of events as they are.

        The points of asks are written once and broadcast within the bound; beyond it
        adaptive execution splits the events of an ask that many have.
        """
        if self.events is None:
            return points
        answers = settled(points.withColumnRenamed("event_id", "ask"), "answers")
        small = fits(answers)
        asking = self.events.select("event_id", "ask", "as_of")
        return asking.join(F.broadcast(answers) if small else answers, "ask").withColumn(
            "event_time", F.coalesce("event_time", "as_of")).select(*names.METRIC.names)


def write_families(evaluation: Evaluation, write: Callable[[DataFrame, str], None]
                   ) -> dict[str, Exception]:
    """Hand the points of each family with work to ``write``, one after the other.

    Families are independent: when one fails, a failure point is written in its place for
    each of its events, and the others go on. Returns what failed.
    """
    failed: dict[str, Exception] = {}
    for family in evaluation.wanted():
        try:
            write(evaluation.of_events(getattr(evaluation, family)()), family)
        except Exception as error:  # noqa: BLE001 - one family must not stop the others
            failed[family] = error
            lost = evaluation.work.where(F.col("metric") == family).withColumn(
                "as_of", F.current_timestamp())
            write(evaluation.of_events(to_points(
                lost, {names.EXECUTION_FAILURE: F.lit(1.0)},
                {"handler_class": F.col("handler")}, evaluation.project)), family)
    return failed


def failure_points(routed: DataFrame, project: str) -> DataFrame:
    """A 1.0 per failed handler, stamped with the time of evaluation."""
    failed = failures(routed).withColumn("as_of", F.current_timestamp())
    matching = F.col("stage") == "match"
    return to_points(failed, {
        names.MATCH_FAILURE: F.when(matching, 1.0), names.EXECUTION_FAILURE: F.when(~matching, 1.0),
    }, {"handler_class": F.col("handler")}, project)
