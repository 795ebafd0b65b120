import random
import re

import numpy as np
import pytest
import xxhash

from claimgauge.llm import simhash
from claimgauge.llm.components import components
from claimgauge.llm.queries import op7_simhash_components
from tests.llm.helpers import awkward, clashing, documents, rows

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints):
    """Root (least index) of every fingerprint by comparing all with all."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= 3:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(fingerprints))]


@pytest.mark.parametrize("text", [
    None, "", "  \n", "One", "One TWO", "a b c", "a b c d", "É Ä a\x0bb\x0cc\td", "ab " * 50,
    " lead and trail\t", "x" * 5000, "a b c d e f g h"])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text():
    dice = random.Random(1)
    text = " ".join(dice.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def clustered(seed, n):
    """Fingerprints around some centres, with chains of few bits."""
    dice = random.Random(seed)
    found = set()
    while len(found) < n:
        at = dice.getrandbits(64)
        for _ in range(dice.choice([1, 1, 5, 60])):
            found.add(at)
            for bit in dice.sample(range(64), dice.randint(1, 4)):
                at ^= 1 << bit
    return sorted(found)[:n]


def labels_of(fps):
    gray = fps.copy()
    for k in (1, 2, 4, 8, 16, 32):
        gray ^= gray >> np.uint64(k)
    order = np.argsort(gray)
    labels = simhash.link_bucket(fps[order])
    found = {}
    for place, label in enumerate(labels):
        found.setdefault(int(label), set()).add(int(fps[order][place]))
    return {frozenset(x) for x in found.values()}


@pytest.mark.parametrize("n", [2, 31, 33, 300, 1500])
def test_index_of_one_bucket_finds_every_link(n):
    fps = clustered(n, n)
    roots = plain_components(fps)
    want = {}
    for fp, root in zip(fps, roots):
        want.setdefault(root, set()).add(fp)
    assert labels_of(np.array(fps, np.uint64)) == {frozenset(x) for x in want.values()}


@pytest.mark.parametrize("n", [2, 33, 700])
def test_index_of_wide_fingerprints_tells_its_links(n):
    dice = np.random.default_rng(n)
    fps = dice.integers(0, 1 << 63, (4, n), np.uint64)
    for i in range(n):                                  # copies of earlier ones, up to 60 bits off
        if i % 3:
            fps[:, i] = fps[:, dice.integers(0, i)]
            for bit in dice.integers(0, 256, dice.integers(0, 60)):
                fps[bit // 64, i] ^= np.uint64(1) << np.uint64(bit % 64)
    fps = fps[:, np.lexsort(simhash.gray_ranks(fps)[::-1])]
    links = []
    labels = simhash.link_bucket(fps, 56, links)
    apart = sum(np.bitwise_count(w[:, None] ^ w[None]).astype(int) for w in fps)
    want, found = np.arange(n), np.arange(n)
    while (want != (least := np.where(apart <= 56, want, n).min(axis=1))).any():
        want = least
    for a, b in links:
        assert (apart[a, b] <= 56).all()
        found = simhash._merge(found, a, b)
    assert (labels == want).all() and (found == want).all() and sum(len(a) for a, _ in links) < 2 * n


def test_gray_ranks_of_several_words():
    steps = [i ^ i >> 1 for i in range(300)]            # neighbours in Gray order are one bit apart
    fps = np.array([[s >> 5 for s in steps], [s << 59 & (1 << 64) - 1 for s in steps]], np.uint64)[:, ::-1]
    fps = fps[:, np.lexsort(simhash.gray_ranks(fps)[::-1])]
    assert (np.bitwise_count(fps[:, 1:] ^ fps[:, :-1]).sum(axis=0) == 1).all()


def test_finer_masks_meet_all_pairs_within_distance():
    dice = random.Random(2)
    masks = simhash.finer_masks(0, 4)
    finer = [x for m in masks for x in simhash.finer_masks(m, 4)]
    assert len(masks) == 4 and all(m.bit_count() == 16 for m in masks)
    for _ in range(200):
        apart = sum(1 << b for b in dice.sample(range(64), 3))
        assert any(not apart & m for m in masks) and any(not apart & m for m in finer)


@pytest.mark.parametrize("bucket_rows", [20_000, 40, 6])
def test_links_at_every_bucket_bound(spark, bucket_rows):
    fps = clustered(9, 400)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    roots = components(simhash.fingerprint_links(frame, bucket_rows))
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in roots.collect()}
    found, want = {}, {}
    for fp, plain in zip(fps, plain_components(fps)):
        found.setdefault(root.get(fp, fp), set()).add(fp)
        want.setdefault(plain, set()).add(fp)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, k) for k in range(101, 160)]
    frame = spark.createDataFrame([*chain, *star, (500, 500), (2, 1), (2, 1)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}}
    assert components(frame.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    prints = [plain_fingerprint(t) for _, t in docs]
    roots = plain_components(prints)
    least = {}
    for (doc_id, _), root in zip(docs, roots):
        least[root] = min(doc_id, least.get(root, doc_id))
    want = sorted((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(docs, prints, roots))
    assert rows(op7_simhash_components(spark, SMALL)) == sorted(want, key=repr)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "fp", "keep", "component_id", "root")
    found = simhash.near_duplicates(docs)
    assert found.count() == docs.count()
    ids = {(r["__id"], r["component_id"]) for r in found.collect()}
    assert {(2, 1), (3, 3), (4, 3), (5, 3), (None, 3)} <= ids     # blank texts are one component
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows(kept, "doc_id", "text")].count(1) == 2   # another text of id 1
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 6, 7, None}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_many_copies_stays(spark):
    docs = documents(spark, [(i, "the very same words in all of these") for i in range(300)])
    kept = simhash.drop_near_duplicates(docs).collect()
    assert [r["doc_id"] for r in kept] == [0]
