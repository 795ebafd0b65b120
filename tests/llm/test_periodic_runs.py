import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimgauge.llm.periodic_runs import find_runs, with_runs
from claimgauge.llm.queries import op11_periodic_runs
from tests.llm.helpers import awkward, clashing, documents

SMALL = "/root/testdata/sf0.001"


def plain_runs(words):
    """By comparing the words with themselves, for every period."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - i >= max(24, 3 * q):
                found.setdefault((i, k + q - i), q)
            i = k + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def of_batch(texts):
    known = {}
    ids = [known.setdefault(w, len(known)) for text in texts for w in text]
    return find_runs(np.array(ids, np.int64), np.array([len(t) for t in texts], np.int64))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=7), st.integers(1, 12)),
                         max_size=6), min_size=1, max_size=4))
def test_against_every_period(blocks):
    texts = [list("".join(piece * times for piece, times in text)) for text in blocks]
    found = of_batch(texts)
    for k, text in enumerate(texts):
        assert found.get(k, []) == plain_runs(text)


@pytest.mark.parametrize("words", [
    "a" * 23, "a" * 24, "ab" * 12, "ab" * 400, "abc" * 8 + "abcab" * 9, "a" * 30 + "b" + "a" * 30,
    "abacabad" * 5 + "xyz" + "abacabad" * 2, "a" * 3000])
def test_known_shapes(words):
    assert of_batch([list(words)]).get(0, []) == plain_runs(list(words))


def test_fibonacci_words_and_long_periods():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    dice = random.Random(5)
    long = [str(dice.randint(0, 10**6)) for _ in range(400)]
    texts = [list(b), long * 3, long * 2 + long[:399], long, ["x"] + long * 4 + ["y"]]
    found = of_batch(texts)
    for k, text in enumerate(texts):
        assert found.get(k, []) == plain_runs(text)
    assert found[1] == [(0, 1200, 400)] and 2 not in found and 3 not in found


def test_a_very_long_text_of_one_word_stays_linear():
    assert of_batch([["a"] * 200_000]) == {0: [(0, 200_000, 1)]}


def test_awkward_rows_keep_their_columns(spark):
    docs = clashing(awkward(spark), "runs", "collapsed", "n_words", "start")
    found = with_runs(docs, batch_words=100).collect()
    assert len(found) == docs.count()
    for r in found:
        words = (r["text"] or "").encode().split()
        assert (r["n_words"], r["start"]) == (len(words), "taken")
        # the long text says its 977 words again and again
        runs = [(0, 30_000, 977)] if len(words) > 1000 else plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"].encode() == b" ".join(words[:977] if runs else words)


def test_empty_table(spark):
    assert with_runs(documents(spark, []).limit(0)).count() == 0


def test_what_a_run_repeats_is_dropped(spark):
    docs = documents(spark, [(1, "so it\xa0is " + "la li  lu\n" * 9 + "la end")])
    row = with_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(2, 28, 3)]
    assert row["collapsed"] == "so it\xa0is la li lu end"


def test_query_against_the_contract(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in op11_periodic_runs(spark, SMALL).collect()}
    assert found.keys() == texts.keys()
    seen = 0
    for doc_id, text in texts.items():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # every period of every word would take minutes here
        runs = plain_runs(words)
        row = found[doc_id]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (
            (len(runs), *best, 1000 * best[1] // best[2]) if best else (0, None, None, None, None))
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
        assert row["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
        assert row["runs_sha256"] == hashlib.sha256(
            "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        seen += len(runs) > 0
    assert seen > 5
