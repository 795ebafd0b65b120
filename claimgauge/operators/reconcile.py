"""What was received, accepted or validated against what was submitted.

Every function takes the :class:`Windows` of one run or of many; its keys name a run,
its lookup columns the tables the run reads.
Values are added up per item before items meet submissions, so neither an item with
many rows nor one submitted many times is multiplied out. The items of all metrics asked for
are written to one table (:class:`Reconciliation`), and submissions are scanned once for
all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.expressions import or_zero, ratio
from claimgauge.operators.joins import attach, fits, linked, salted_anti, salted_semi
from claimgauge.operators.windows import Windows
from claimgauge.schemas import (
    APPROVED,
    NOT_SENT,
    PENDING,
    SHARED_INVOICE,
    SUBMITTED_OK,
)
from claimgauge.session import settled


def pending_invoices(in_window: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Invoices with an item still out for validation."""
    waiting = in_window.where(F.col("status") == PENDING).where(F.col("invoice_id").isNotNull())
    return waiting.select(*keys, "invoice_id").distinct()


def non_sendable_items(in_window: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Items of pending invoices, whatever their own status."""
    pending = pending_invoices(in_window, keys)
    rows = in_window.where(F.col("invoice_id").isNotNull()).select(*keys, "invoice_id", "item_id")
    held = salted_semi(rows, pending, [*keys, "invoice_id"], ["item_id"])
    return held.select(*keys, "item_id").distinct()


def received_in_window(received: DataFrame, windows: Windows) -> DataFrame:
    """Received claim rows in the window, equal (item, paid, reported) rows once."""
    values = ["item_id", "paid_value", "reported_value"]
    rows = windows.of_rows(received.select(*windows.lookup, *values, "ingested_at"))
    return rows.select(*windows.keys, *values).distinct()


def sendable_items(received: DataFrame, validation: DataFrame, windows: Windows) -> DataFrame:
    """Received items that no pending invoice holds back, one row per item with its
    summed ``paid_value`` and ``reported_value``."""
    keys = windows.keys
    items = received_in_window(received, windows).groupBy(*keys, "item_id").agg(
        F.sum("paid_value").alias("paid_value"), F.sum("reported_value").alias("reported_value")
    )
    in_window = windows.of_rows(validation.select(
        *windows.lookup, "item_id", "invoice_id", "status", "ingested_at"))
    return items.join(non_sendable_items(in_window, keys), [*keys, "item_id"], "left_anti")


def _per_status(windows: Windows, sums: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The observed statuses of each run, and SUBMITTED_SUCCESS in any case."""
    required = windows.runs(sums).withColumn("status", F.lit(SUBMITTED_OK))
    return sums.unionByName(required, allowMissingColumns=True).groupBy(
        *windows.keys, "status").agg(*[F.sum(c).alias(c) for c in columns])


def _unless_null_status(value: Column) -> Column:
    # a NULL status equals no status, so its sum is not found again
    return F.when(F.col("status").isNotNull(), value)


class Reconciliation:
    """The items of some metrics (``kinds``: received, accepted, analysed, shared) in one
    table of columns, and the submitted rows that they have, of any run and time.

    Each kind is a frame of the windows' keys, ``item_id`` and ``paid_value`` and
    ``reported_value``, or ``saving_value``. The history of submissions is read once, cut down to
    the items, and rolled up per item and status for all kinds together.
    """

    def __init__(self, windows: Windows, submitted: DataFrame, **kinds: DataFrame):
        self.windows, items = windows, None
        for kind, frame in kinds.items():
            named = frame.withColumn("kind", F.lit(kind))
            items = named if items is None else items.unionByName(named, allowMissingColumns=True)
        self.items = settled(items, "items", "kind")
        on = [*windows.lookup, "item_id"]
        wanted = self.items.select(*on).where(F.col("item_id").isNotNull()).distinct()
        sums = [F.count(F.lit(1)).alias("_times")]
        if "saving_value" in submitted.columns:
            sums.append(F.sum("saving_value").alias("_sent"))
        by = [c for c in ("status",) if c in submitted.columns]
        rolled = linked(submitted, wanted, on, fits(wanted), "left_semi").groupBy(*on, *by).agg(*sums)
        self.sent = settled(rolled, "sent") if len(kinds) > 1 else rolled

    def of(self, kind: str) -> DataFrame:
        return self.items.where(F.col("kind") == kind).drop("kind")

    def met(self, kind: str) -> DataFrame:
        """The items of a kind with what was submitted of each."""
        return self.of(kind).join(self.sent, [*self.windows.lookup, "item_id"])

    def received(self) -> DataFrame:
        """:func:`sent_over_received`."""
        keys = self.windows.keys
        totals = self.of("received").groupBy(*keys).agg(
            F.sum("paid_value").alias("_all_paid"), F.sum("reported_value").alias("_all_reported"))
        sent = self.met("received").groupBy(*keys, "status").agg(
            F.sum(F.col("paid_value") * F.col("_times")).alias("_paid"),
            F.sum(F.col("reported_value") * F.col("_times")).alias("_reported"))
        rows = attach(_per_status(self.windows, sent, ["_paid", "_reported"]), totals, keys,
                      ["_all_paid", "_all_reported"])

        def share(part: str, whole: str) -> Column:
            sent_share = ratio(_unless_null_status(F.col(part)), F.col(whole))
            return F.when(or_zero(F.col(whole)) == 0, F.lit(1.0)).otherwise(or_zero(sent_share))

        return rows.select(*keys, "status", share("_paid", "_all_paid").alias("paid_share"),
                           share("_reported", "_all_reported").alias("reported_share"))

    def _totals(self, kind: str) -> DataFrame:
        return self.of(kind).groupBy(*self.windows.keys).agg(F.sum("saving_value").alias("_total"))

    def by_status(self, kind: str) -> DataFrame:
        """Per status, submitted over known saving of accepted or analysed items."""
        keys = self.windows.keys
        sent = self.met(kind).groupBy(*keys, "status").agg(F.sum("_sent").alias("_sent"))
        return ratio_with_empty_rule(_per_status(self.windows, sent, ["_sent"]),
                                     self._totals(kind), keys)

    def shared(self) -> DataFrame:
        """:func:`shared_invoice_completeness`."""
        keys = self.windows.keys
        sent = self.met("shared").groupBy(*keys).agg(F.sum("_sent").alias("_sent"))
        runs = attach(attach(self.windows.runs(self.items), self._totals("shared"), keys, ["_total"]),
                      sent, keys, ["_sent"])
        whole = or_zero(F.col("_total"))
        share = F.when(whole > 0, ratio(or_zero(F.col("_sent")), whole)).otherwise(F.lit(1.0))
        return runs.select(*keys, share.alias("share"))


def sent_over_received(received: DataFrame, validation: DataFrame, submitted: DataFrame,
                       windows: Windows) -> DataFrame:
    """Per submission status, the part of the sendable paid and reported value sent.

    Each submitted row of a sendable item counts, of any run and time. With nothing to
    send, every status reads 1.
    """
    sendable = sendable_items(received, validation, windows)
    sent = submitted.select(*windows.lookup, "item_id", "status")
    return Reconciliation(windows, sent, received=sendable).received()


def _by_item(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "item_id").agg(F.sum("saving_value").alias("saving_value"))


def ratio_with_empty_rule(by_status: DataFrame, total: DataFrame,
                          keys: Sequence[str] = ()) -> DataFrame:
    """Sent over total per status. A run with total 0 and nothing positive sent has the
    single row SUBMITTED_SUCCESS = 1; a total not above 0 else makes every share 0."""
    by_status = by_status.withColumn("_sent", or_zero(_unless_null_status(F.col("_sent"))))
    peak = by_status.groupBy(*keys).agg(F.max("_sent").alias("_peak"))
    rows = attach(attach(by_status, total, keys, ["_total"]), peak, keys, ["_peak"])
    whole = or_zero(F.col("_total"))
    idle = (whole == 0) & (F.col("_peak") <= 0)
    share = (F.when(idle, F.lit(1.0))
             .when(whole > 0, ratio(F.col("_sent"), whole)).otherwise(F.lit(0.0)))
    return rows.where(~idle | F.col("status").eqNullSafe(F.lit(SUBMITTED_OK))).select(
        *keys, "status", share.alias("share"))


def _submitted_savings(submitted: DataFrame, windows: Windows, *more: str) -> DataFrame:
    return submitted.select(*windows.lookup, "item_id", *more, "saving_value")


_SAVING = ["item_id", "saving_value"]


def accepted_savings(selected: DataFrame, validation: DataFrame, windows: Windows) -> DataFrame:
    """Selected savings, and approved or sent validation rows on settled invoices."""
    keys, lookup = windows.keys, windows.lookup
    chosen = windows.of_rows(selected.select(*lookup, *_SAVING, "ingested_at"))
    in_window = windows.of_rows(
        validation.select(*lookup, *_SAVING, "invoice_id", "status", "ingested_at"))
    settled = salted_anti(
        in_window.where(F.col("status").isin(SUBMITTED_OK, APPROVED)),
        pending_invoices(in_window, keys), [*keys, "invoice_id"], ["item_id"])
    return chosen.select(*keys, *_SAVING).unionByName(settled.select(*keys, *_SAVING))


def accepted_items(selected: DataFrame, validation: DataFrame, windows: Windows) -> DataFrame:
    """Accepted savings per item."""
    return _by_item(accepted_savings(selected, validation, windows), windows.keys)


def sent_over_accepted(selected: DataFrame, validation: DataFrame, submitted: DataFrame,
                       windows: Windows) -> DataFrame:
    """Per status, submitted saving of accepted items over the accepted saving."""
    items = accepted_items(selected, validation, windows)
    sent = _submitted_savings(submitted, windows, "status")
    return Reconciliation(windows, sent, accepted=items).by_status("accepted")


def analysed_savings(validation: DataFrame, windows: Windows) -> DataFrame:
    """Validation rows that were looked at and not held for a shared invoice."""
    rows = validation.where(~F.col("status").isin(PENDING, NOT_SENT)).where(
        ~F.col("filtered_reason").eqNullSafe(F.lit(SHARED_INVOICE)))
    return windows.of_rows(rows.select(*windows.lookup, *_SAVING, "ingested_at"))


def analysed_items(validation: DataFrame, windows: Windows) -> DataFrame:
    """Analysed savings per item."""
    return _by_item(analysed_savings(validation, windows), windows.keys)


def shared_items(validation: DataFrame, windows: Windows) -> DataFrame:
    """Savings per item of rows held for a shared invoice and not out for validation."""
    rows = validation.where(F.col("filtered_reason") == SHARED_INVOICE).where(
        F.col("status") != PENDING)
    return _by_item(windows.of_rows(rows.select(*windows.lookup, *_SAVING, "ingested_at")), windows.keys)


def sent_over_validation(validation: DataFrame, submitted: DataFrame,
                         windows: Windows) -> DataFrame:
    """Per status, submitted saving of analysed items over the analysed saving."""
    sent = _submitted_savings(submitted, windows, "status")
    return Reconciliation(windows, sent, analysed=analysed_items(validation, windows)
                          ).by_status("analysed")


def shared_invoice_completeness(validation: DataFrame, submitted: DataFrame,
                                windows: Windows) -> DataFrame:
    """Submitted over known saving of items held for a shared invoice; 1 without any."""
    sent = _submitted_savings(submitted, windows)
    return Reconciliation(windows, sent, shared=shared_items(validation, windows)).shared()
