"""The stages, each held against a plain version on its own input."""

import pytest

import corpus_pipeline
from claimgauge.llm.common import table, written
from tests.llm.helpers import awkward, documents
from tests.llm.test_near_copies import plain_roots

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SMALL), f"test-{name}")
        out.append((name, docs, result))
        docs = result
    return out


def test_all_but_the_last_keep_the_columns(stages):
    for name, docs, result in stages[:-1]:
        assert result.columns == docs.columns, name
        assert result.count() > 0


def test_toxicity_drops_only_rejected_rows(stages):
    _, docs, result = stages[0]
    assert result.exceptAll(docs).count() == 0


def test_one_of_each_component_stays(stages):
    _, docs, result = stages[1]
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    roots = plain_roots([text for _, text in rows])
    assert sorted(r["doc_id"] for r in result.collect()) == sorted(
        rows[i][0] for i, root in enumerate(roots) if i == root)


def test_no_benchmark_item_is_left(spark, stages):
    _, docs, result = stages[2]
    items = [r["text"] for r in table(spark, SMALL, "benchmark").collect()]
    left = {r["doc_id"] for r in result.collect()}
    leaks = {r["doc_id"] for r in docs.collect() if any(t in r["text"] for t in items)}
    assert not leaks & left


def test_mixing_only_repeats_or_drops_whole_rows(stages):
    _, docs, result = stages[3]
    assert result.distinct().exceptAll(docs.distinct()).count() == 0
    assert result.count() >= 0.8 * docs.count()


def test_shards_hold_all_rows(stages):
    _, docs, result = stages[4]
    assert result.select(*docs.columns).exceptAll(docs).count() == 0 and result.count() == docs.count()
    assert {"shard", "slot", "size"} <= set(result.columns)


def test_awkward_and_empty_tables_pass_all_stages(spark):
    for docs in (awkward(spark), documents(spark, [(1, "x")]).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.count() >= 0
