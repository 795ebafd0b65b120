import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimgauge.llm.queries import op1_histogram_sharding
from claimgauge.llm.sharding import histogram_shards
from tests.llm.helpers import SCHEMA, awkward, clashing, documents

SMALL = "/root/testdata/sf0.001"


def check_slots(found):
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_awkward_rows_keep_their_columns(spark):
    docs = clashing(awkward(spark), "size", "shard", "key", "range")
    found = histogram_shards(docs, shards=3).collect()
    assert len(found) == docs.count()
    assert {r["key"] for r in found} == {"taken"}
    assert {r["size"] for r in found if r["text"] is None} == {1}
    assert all(0 <= r["shard"] < 3 for r in found)
    check_slots(found)


def test_empty_table(spark):
    assert histogram_shards(documents(spark, []).limit(0), shards=4).count() == 0


def test_bytes_are_even_and_groups_hold_together(spark):
    dice = random.Random(3)
    rows = [(i, "x" * dice.randint(0, 400) + str(i % 700)) for i in range(2100)]
    found = histogram_shards(documents(spark, rows), shards=7, probes=16).collect()
    total = sum(r["size"] for r in found)
    by = [sum(r["size"] for r in found if r["shard"] == s) for s in range(7)]
    assert max(by) - min(by) <= 0.06 * total / 7 + 800
    cut = len({(r["text"], r["shard"]) for r in found}) - len({r["text"] for r in found})
    assert cut <= 6
    check_slots(found)


def test_a_group_of_a_third_of_all_rows_is_cut(spark):
    rows = [(i, "same" * 20 if i % 3 == 0 else f"text number {i} " * 4) for i in range(3000)]
    found = histogram_shards(documents(spark, rows), shards=8, range_bytes=4000).collect()
    by = [sum(r["size"] for r in found if r["shard"] == s) for s in range(8)]
    assert max(by) <= 1.05 * sum(by) / 8
    check_slots(found)


def test_a_third_of_all_rows_alike_in_text_and_id_is_cut(spark):
    rows = [(None, "same" * 20) if i % 3 == 0 else (i, f"text number {i} " * 4) for i in range(9000)]
    found = histogram_shards(documents(spark, rows), range_bytes=40_000).collect()
    assert len(found) == 9000
    by = [sum(r["size"] for r in found if r["shard"] == s) for s in range(16)]
    assert max(by) <= 1.02 * sum(by) / 16 + 100 and min(by) >= 0.98 * sum(by) / 16 - 100
    check_slots(found)


def test_more_shards_than_rows_and_any_key(spark):
    found = histogram_shards(documents(spark, [(1, "a"), (2, "b")]), shards=16).collect()
    assert len(found) == 2
    check_slots(found)
    ordered = histogram_shards(documents(spark, [(i, "abc") for i in range(100)]), shards=4,
                               key=F.shiftleft("doc_id", 33))
    ordered = sorted(ordered.collect(), key=lambda r: r["doc_id"])
    assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in ordered)
    assert [r["shard"] for r in ordered].count(0) == 25


def test_query_contract(spark):
    found = op1_histogram_sharding(spark, SMALL)
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
        "slot": "bigint", "grown_shard": "int"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = found.collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "bytes")
    check_slots(found)


@pytest.mark.parametrize("shards", [1, 2])
def test_few_shards(spark, shards):
    found = histogram_shards(spark.createDataFrame([(1, "a", "e", "s", 1)], SCHEMA), shards=shards)
    assert [r["slot"] for r in found.collect()] == [0]
