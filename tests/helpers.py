"""Building small tables and comparing results exactly."""

from __future__ import annotations

import base64
import json
from datetime import UTC, datetime, timedelta

from pyspark.sql import types as T

from claimgauge import schemas
from claimgauge.operators.routing import check_tables, route_events
from claimgauge.plans.evaluate import Evaluation, Tables
from claimgauge.sources.events import decode_events
from claimgauge.sources.tables import manifest_of

T0 = datetime(2024, 1, 15, 10, 30, tzinfo=UTC)


def ago(base: datetime = T0, **delta) -> datetime:
    return base - timedelta(**delta)


def frame(spark, schema: T.StructType, rows: list[dict]):
    """Rows given as dicts; columns left out are NULL."""
    def value(row, field):
        v = row.get(field.name)
        if isinstance(field.dataType, T.TimestampNTZType) and v is not None:
            return v.replace(tzinfo=None)
        return v

    return spark.createDataFrame([tuple(value(r, f) for f in schema.fields) for r in rows], schema)


def tables(spark, claims=(), savings=(), validation=(), submitted=()) -> Tables:
    return Tables(frame(spark, schemas.CLAIMS, list(claims)),
                  frame(spark, schemas.SAVINGS, list(savings)),
                  frame(spark, schemas.VALIDATION, list(validation)),
                  frame(spark, schemas.SUBMITTED, list(submitted)))


def event(pipeline: str, variables: dict | None, status: str = "COMPLETED", when: str | None = None,
          wrapped: bool = True) -> str:
    payload = {"pipeline_uuid": pipeline, "status": status, "variables": variables}
    doc = json.dumps({"source_timestamp": when or T0.isoformat().replace("+00:00", "Z"),
                      "payload": payload})
    if not wrapped:
        return doc
    return json.dumps({"message": {"data": base64.b64encode(doc.encode()).decode()}})


def raw_events(spark, *events: str):
    return spark.createDataFrame([(f"e{i}", e) for i, e in enumerate(events)],
                                 "event_id string, raw string")


def evaluation(spark, data: Tables, *events: str, manifest=None) -> Evaluation:
    routed = route_events(decode_events(raw_events(spark, *events)))
    if manifest is None:
        manifest = manifest_of(data.claims, data.savings, data.validation, data.submitted)
    else:
        manifest = spark.createDataFrame([(m,) for m in manifest], "table_ref string")
    return Evaluation(check_tables(routed, manifest, "main"), data, "test")


def points(frame_) -> set:
    """Points as (metric, value, labels), all of them."""
    rows = frame_.collect()
    found = {(r.metric_name, round(r.value, 12), tuple(sorted(r.labels.items()))) for r in rows}
    assert len(found) == len(rows), "duplicate points"
    return found


def point(metric: str, value: float, **labels: str):
    return (metric, round(value, 12), tuple(sorted(labels.items())))
