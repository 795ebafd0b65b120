"""Base64 texts that are not clean are decoded at about the pace of clean ones."""

import base64
import json
import time

from pyspark.sql import functions as F

from claimgauge.sources.events import decode_events


def test_surplus_padding_costs_no_search_by_character(spark):
    doc = json.dumps({"source_timestamp": "2024-01-15T10:30:00Z", "payload": {"x": "y" * 60_000}})
    plain = base64.b64encode(doc.encode()).decode()
    texts = {"plain": plain, "padded": plain[:40] + "\n" + plain[40:] + "==", "foreign": "=-" + plain[:50] + "_*" + plain[50:]}
    rows = {kind: spark.range(0, 150, 1, 1).select(F.col("id").cast("string").alias("event_id"), F.lit(
        json.dumps({"message": {"data": text}})).alias("raw")).localCheckpoint() for kind, text in texts.items()}

    def seconds(kind):
        began = time.time()
        found = decode_events(rows[kind]).groupBy("decoding").count().collect()
        assert [tuple(r) for r in found] == [("decoded", 150)], kind
        return time.time() - began

    for kind in texts:
        seconds(kind)
    assert seconds("padded") < 8 * seconds("plain") + 1.5
