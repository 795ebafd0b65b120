"""Near copies against all pairs of sets, on edited copies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimgauge.llm import near_copies, simhash
from tests.llm.helpers import awkward, documents, rows


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_roots(texts, least=0.8):
    sets, roots = [shingles(t) for t in texts], list(range(len(texts)))
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if (not one and not two) or len(one & two) >= least * len(one | two):
                low, high = sorted((roots[i], roots[j]))
                roots = [low if r == high else r for r in roots]
    return roots


def edited_copies(seed=3, sources=25, copies=6):
    dice = random.Random(seed)
    texts = []
    for _ in range(sources):
        words = [f"w{dice.randrange(5000)}" for _ in range(dice.randrange(90, 200))]
        texts.append(" ".join(words))
        for _ in range(copies):
            copy = list(words)
            for at in dice.sample(range(len(words)), dice.randrange(0, 6)):
                copy[at] = f"new{dice.randrange(5000)}"
            texts.append(" ".join(copy))
    return texts


def test_stage_drops_edited_copies(spark):
    texts = edited_copies()
    docs = documents(spark, list(enumerate(texts)))
    want = [i for i, root in enumerate(plain_roots(texts)) if i == root]
    assert len(want) < len(texts) / 2
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_simhash_index_alone_drops_edited_copies(spark, monkeypatch):
    """The named method does the work: without the MinHash way that follows, few copies stay."""
    monkeypatch.setattr(near_copies, "set_links", lambda sets, members, known, part_rows: known)
    texts = edited_copies(11, 60, 6)
    roots = plain_roots(texts)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents(spark, list(enumerate(texts))), "").collect()}
    firsts = {i for i, root in enumerate(roots) if i == root}
    assert firsts <= kept                               # links are checked, so nothing else goes
    copies = len(texts) - len(firsts)
    assert copies > 200 and len(kept - firsts) <= 0.1 * copies


@pytest.mark.parametrize("bucket_rows", [20_000, 3])
def test_close_pairs_are_close_and_connect_pairs_that_share_a_block(spark, bucket_rows):
    texts = edited_copies(12, 12, 8)
    prints = [simhash.wide_fingerprint(near_copies.shingle_set(t)) for t in texts]
    frame = spark.createDataFrame([(i, p.view(np.int64).tolist()) for i, p in enumerate(prints)],
                                  "node long, print array<long>")
    pairs = [(r["a"], r["b"]) for r in near_copies.close_pairs(frame, bucket_rows).collect()]
    roots = list(range(len(texts)))
    for i, j in pairs:
        assert np.bitwise_count(prints[i] ^ prints[j]).sum() <= near_copies.RADIUS
        low, high = sorted((roots[i], roots[j]))
        roots = [low if r == high else r for r in roots]
    blocks = [{(k, int(w) >> 12 * at & 4095, at) for k, w in enumerate(p) for at in range(5)} for p in prints]
    met = [(i, j) for j in range(len(texts)) for i in range(j) if blocks[i] & blocks[j]
           and np.bitwise_count(prints[i] ^ prints[j]).sum() <= near_copies.RADIUS]
    apart = [p for p in met if roots[p[0]] != roots[p[1]]]
    assert len(met) > 200 and (not apart if bucket_rows > 3 else len(apart) < 0.1 * len(met))


@pytest.mark.parametrize("part_rows", [1_000, 8])
def test_chain_of_copies_in_small_parts(spark, part_rows):
    dice = random.Random(1)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(60):                        # each some words from the one before
        words = list(words)
        words[dice.randrange(150)] = f"v{i}"
        texts.append(" ".join(words))
    texts += edited_copies(4, 3, 30)
    kept = near_copies.drop_near_copies(documents(spark, list(enumerate(texts))), part_rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == [
        i for i, root in enumerate(plain_roots(texts)) if i == root]


def test_links_of_a_bucket_equal_all_pairs():
    texts = edited_copies(5, 8, 8)
    sets = [near_copies.shingle_set(t) for t in texts]
    roots = list(range(len(texts)))
    for i, j in near_copies.link_sets(sets, np.arange(len(sets))):
        low, high = sorted((roots[i], roots[j]))
        roots = [low if r == high else r for r in roots]
    assert roots == plain_roots(texts)


def test_groups_get_their_totals_by_cells(spark):
    frame = spark.createDataFrame([(i % 7 if i % 3 else -1, i) for i in range(900)] + [(None, 1), (50, 2)],
                                  "key long, n long")
    got = near_copies.with_facts(frame, "key", "n", F.min("n").alias("least"), F.count("*").alias("size"),
                                 where="size > 1")
    groups = {}
    for key, n in frame.collect():
        groups.setdefault(key, []).append(n)
    assert rows(got, "key", "n", "least", "size") == sorted(
        ((k, n, min(ns), len(ns)) for k, ns in groups.items() if k is not None and len(ns) > 1
         for n in ns), key=repr)
    assert not near_copies.with_facts(frame.limit(0), "key", "n", F.count("*").alias("size")).count()


def test_hot_bucket_is_joined_in_parts(spark):
    """A bucket of a third of all rows is spread over cells, so no join is on the bucket alone."""
    frame = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("bucket"),
                                       F.col("id").alias("node"), F.col("id").alias("label"))
    got = near_copies._several(frame)
    assert got.count() == 10_000
    parts = frame.withColumn("cell", F.pmod(F.xxhash64("node"), F.lit(near_copies.CELLS))).groupBy(
        "bucket", "cell").count()
    assert parts.agg(F.max("count")).first()[0] < 250
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("cell#" in line for line in joins)


def test_awkward_rows(spark):
    docs = awkward(spark)
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows(kept, "doc_id", "text")].count(1) == 2
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 6, 7, None}
    assert near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_a_bucket_that_is_cut_loses_no_pair(spark):
    dice = np.random.default_rng(5)
    prints, pairs = [], []
    for k in range(12):  # alike in the first block only, and two by two within the radius
        one = dice.integers(0, 1 << 63, simhash.WORDS, np.uint64)
        one[0] = (one[0] >> np.uint64(12) << np.uint64(12)) | np.uint64(77)
        two = one.copy()
        for block in range(1, near_copies.BLOCKS):
            word, place = divmod(block, near_copies.WORD_BLOCKS)
            two[word] ^= np.uint64(1 << 12 * place)
        pairs.append((2 * k, 2 * k + 1))
        prints += [(2 * k, one.view(np.int64).tolist()), (2 * k + 1, two.view(np.int64).tolist())]
    frame = spark.createDataFrame(prints, "node long, print array<long>")
    for bucket_rows in (3, 10, 20_000):
        found = near_copies.close_pairs(frame, bucket_rows).distinct()
        assert sorted(map(tuple, found.collect())) == pairs, bucket_rows


def test_a_pair_behind_links_that_fail_is_compared(spark):
    sets = spark.createDataFrame([(1, list(range(20))), (2, list(range(8, 30))), (3, list(range(1, 21))),
                                  (4, list(range(50, 60)))], "node long, hashes array<long>")
    close = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")  # a tree: 1 and 3 are not a link
    known = near_copies._checked(close, sets)
    assert known.isEmpty()
    links = near_copies.set_links(sets, near_copies.tree_members(close), known)
    assert {tuple(sorted(r)) for r in links.collect()} == {(1, 3)}
