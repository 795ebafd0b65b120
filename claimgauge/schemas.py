"""Declared table schemas and the fixed values the metrics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _TS, _NTZ = T.StringType(), T.DoubleType(), T.TimestampType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# One row per claim item. Batch tables, received-claims history and entity history
# are all of this shape; a query reads only the columns it names.
CLAIMS = _schema(
    table_ref=_S, item_id=_S, invoice_id=_S, provider_id=_S, member_id=_S,
    paid_value=_D, reported_value=_D, created_at=_TS, ingested_at=_TS,
)
SAVINGS = _schema(table_ref=_S, item_id=_S, agent_id=_S, saving_value=_D, ingested_at=_TS)
VALIDATION = _schema(
    table_ref=_S, item_id=_S, invoice_id=_S, saving_value=_D, status=_S, filtered_reason=_S,
    ingested_at=_TS, updated_at=_NTZ,
)
SUBMITTED = _schema(
    table_ref=_S, item_id=_S, saving_value=_D, submission_run_id=_S, status=_S, ingested_at=_TS,
)
RAW_EVENT = _schema(event_id=_S, raw=_S)
METRIC = T.StructType([
    T.StructField("metric_name", _S, True),
    T.StructField("value", _D, True),
    T.StructField("labels", T.MapType(_S, _S, True), True),
    T.StructField("project", _S, True),
    T.StructField("event_time", _TS, True),
    T.StructField("event_id", _S, True),
])

# ---- fixed values ---------------------------------------------------------------
COMPLETED = "COMPLETED"

PENDING = "SENT_FOR_VALIDATION"
NOT_SENT = "NOT_SENT_FOR_VALIDATION"
APPROVED = "APPROVED"
SUBMITTED_OK = "SUBMITTED_SUCCESS"
EXPIRED = "EXPIRED"
SHARED_INVOICE = "SHARED_ID_FATURA"

RUN_COUNT = "pipeline_run/count"
PRE_TOTAL = "claims/pipeline/filtered_pre/paid_value/total"
PRE_RELATIVE = "claims/pipeline/filtered_pre/paid_value/relative"
PROCESSABLE_TOTAL = "claims/pipeline/processable/paid_value/total"
PROCESSABLE_RELATIVE = "claims/pipeline/processable/paid_value/relative"
POST_TOTAL = "claims/pipeline/filtered_post/saving_value/total"
POST_RELATIVE = "claims/pipeline/filtered_post/saving_value/relative"
SAVINGS_VALUE = "claims/pipeline/savings/saving_value"
SAVINGS_COUNT = "claims/pipeline/savings/count"
SELECTED_VALUE = "claims/savings/approved/saving_value"
NEW_PROVIDERS = "claims/pipeline/providers/new_pct_last_3_mo"
NEW_MEMBERS = "claims/pipeline/beneficiaries/new_pct_last_3_mo"
PROVIDER_RATIO = "claims/pipeline/providers/volume_ratio_last_1_mo"
MEMBER_RATIO = "claims/pipeline/beneficiaries/volume_ratio_last_1_mo"
SENT_PAID = "claims/pipeline/claims/paid_value/sent_over_recv_last_2_days"
SENT_REPORTED = "claims/pipeline/claims/reported_value/sent_over_recv_last_2_days"
SENT_ACCEPTED = "claims/pipeline/savings/saving_value/sent_over_accepted_last_2_days"
SENT_VALIDATION = "claims/pipeline/savings/saving_value/sent_over_validation_last_2_days"
SHARED_SENT = "claims/pipeline/savings/saving_value/shared_invoice_sent_over_validation"
EXPIRED_TOTAL = "claims/pipeline/validation/saving_value/expired/total"
MATCH_FAILURE = "handler_matcher_failure"
EXECUTION_FAILURE = "handler_execution_failure"
