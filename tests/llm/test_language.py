import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from claimgauge.llm import language
from claimgauge.llm.queries import op2_ppm_language
from tests.llm.helpers import awkward, clashing, documents, fold, rows

SMALL = "/root/testdata/sf0.01"


def counted(lang, text):
    data = b"\n\n\n" + text.encode()
    grams = Counter(int.from_bytes(data[i - 3:i + 1], "big") for i in range(3, len(data)))
    return pd.DataFrame({"lang": lang, "gram": list(grams), "n": list(grams.values())}).astype(
        {"gram": "int64", "n": "int64"})


class PlainTree:
    """Byte by byte, straight from the definition."""

    def __init__(self, text):
        data = b"\n\n\n" + text.encode()
        self.seen = defaultdict(Counter)
        for i in range(3, len(data)):
            for k in range(4):
                self.seen[data[i - k:i]][data[i]] += 1

    def bits(self, text):
        data, total = b"\n\n\n" + text.encode(), 0.0
        for i in range(3, len(data)):
            gone = set()
            for k in (3, 2, 1, 0):
                counts = {b: n for b, n in self.seen.get(data[i - k:i], {}).items() if b not in gone}
                if not counts:
                    continue
                whole = sum(counts.values()) + len(counts)
                if data[i] in counts:
                    total -= math.log2(counts[data[i]] / whole)
                    break
                total -= math.log2(len(counts) / whole)
                gone |= set(counts)
            else:
                total += math.log2(256 - len(gone))
        return total


LEARNT = {"aa": "the cat sat on the mat and the dog ate the hat " * 4 + "zebra",
          "bb": "le chat dort sur le tapis et le chien mange été " * 3}
TEXTS = ["the cat", "le chat", "x", "zzzz", "1234 été", "the the the le le", "漢字", "ab" * 300]


def model():
    return language.LanguageModel(pd.concat([counted(x, t) for x, t in LEARNT.items()]))


def test_code_lengths_are_exact():
    found = model().code_lengths(TEXTS)
    for text, row in zip(TEXTS, found):
        assert np.allclose(row, [PlainTree(t).bits(text) for t in LEARNT.values()], rtol=1e-5)


def test_pieces_do_not_change_code_lengths(monkeypatch):
    whole = model().code_lengths(TEXTS)
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose(model().code_lengths(TEXTS), whole, rtol=1e-5)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "lang_pred", "score", "n", "hash")
    trained = language.train(docs, folds=1, fold=5)
    assert trained.languages == ["de", "en", "fr"]
    found = language.with_language(docs, trained)
    got = found.collect()
    assert len(got) == docs.count()
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1
        assert r["n"] == "taken"


def test_nothing_learnt_and_empty_table(spark):
    docs = documents(spark, [(1, "text", None)])
    found = language.with_language(docs, language.train(docs))
    assert [r["lang_pred"] for r in found.collect()] == ["und"]
    assert language.with_language(docs.limit(0), model()).count() == 0


def test_ties_go_to_the_first_language(spark):
    twins = language.LanguageModel(pd.concat([counted(x, "same text") for x in ("zz", "aa")]))
    found = language.with_language(documents(spark, [(1, "same")]), twins).first()
    assert (found["lang_pred"], found["score"]) == ("aa", 0.5)


def test_sample_keeps_its_bound(spark):
    docs = documents(spark, [(i, f"text {'abcdefgh'[i % 8] * 5}", "en") for i in range(400)])
    small = language.train(docs, rows=3)
    assert 0 < len(small.trees[0].grams[3]) < len(language.train(docs, rows=400).trees[0].grams[3])


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = rows(op2_ppm_language(spark, SMALL), "doc_id", "held_out", "lang_pred", "score")
    assert [r[0] for r in sorted(found)] == sorted(docs)
    assert all(r[1] == (fold(r[0], 5) == 0) for r in found)
    held = [r for r in found if r[1]]
    assert sum(docs[r[0]]["lang"] == r[2] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("text,und", [("123 !!", True), ("", True), ("é", False), ("漢", False)])
def test_letters(spark, text, und):
    found = language.with_language(documents(spark, [(1, text)]), model()).first()
    assert (found["lang_pred"] == "und") == und


def test_repeated_rows_are_learnt_once(spark):
    one = [(i, f"some english text number {i}", "en") for i in range(40)]
    once = language.train(documents(spark, one))
    again = language.train(documents(spark, one * 7))
    probe = ["some text", "english number 3", "xyz"]
    assert np.array_equal(once.code_lengths(probe), again.code_lengths(probe))
