import random

import numpy as np
import pytest

from claimgauge.llm import toxicity
from claimgauge.llm.queries import op5_factorization_toxicity
from tests.llm.helpers import awkward, clashing, documents, fold, rows

SMALL = "/root/testdata/sf0.1"


def machine(seed=0, terms=12):
    values = np.random.default_rng(seed).normal(0, 0.5, 1 + terms * (1 + toxicity.RANK))
    return toxicity.FactorizationMachine(np.arange(terms), values)


def test_margin_is_the_sum_over_pairs():
    it = machine()
    bias, weights, vectors = it.parts()
    rows_ = [[], [3], [0, 4, 7, 11]]
    for row, got in zip(rows_, it.margins(rows_)):
        pairs = sum(vectors[i] @ vectors[j] for i in row for j in row if i < j)
        assert np.isclose(got, bias + sum(weights[i] for i in row) + pairs)


def test_slope_is_the_derivative_of_the_loss():
    it, rows_ = machine(1), [[0, 1, 5], [2], [], [1, 5, 9, 10]]
    labels, weights = np.array([1, 0, 1, 0]), np.array([1.0, 2.0, 1.0, 0.5])
    slope = it.slope(rows_, labels, weights)[1]
    for k in range(0, len(it.values), 7):
        step = np.zeros(len(it.values))
        step[k] = 1e-6
        up, down = (toxicity.FactorizationMachine(it.terms, it.values + s).slope(rows_, labels, weights)[0]
                    for s in (step, -step))
        assert np.isclose((up - down) / 2e-6, slope[k], atol=1e-5)


def planted_pair(spark, dice, words_of_pair, n=1_200):
    """Texts that are toxic exactly if one of two signs is there without the other."""
    texts, labels = [], []
    for i in range(n):
        a, b = dice.random() < 0.5, dice.random() < 0.5
        words = [dice.choice("plain words of no account whatsoever here".split()) for _ in range(6)]
        texts.append((i, " ".join(words + words_of_pair(a, b))))
        labels.append((i, int(a != b)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


@pytest.mark.parametrize("words_of_pair", [
    lambda a, b: ["rotten"] * a + ["neighbours"] * b,
    lambda a, b: ["rotten" if a else "lovely", "neighbours" if b else "strangers"],
], ids=["exclusive or", "balanced"])
def test_learns_a_pair_without_single_effects(spark, words_of_pair):
    docs, labels, truth = planted_pair(spark, random.Random(4), words_of_pair)
    trained = toxicity.train(docs, labels)
    found = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.with_toxicity(docs, trained).collect()}
    held = [(i, y) for i, y in truth if fold(i, 4) == 2]
    assert sum(found[i] for i, y in held if y) >= 0.9 * sum(y for _, y in held)
    assert sum(found[i] for i, y in held if not y) <= 0.1 * len(held)


def test_pair_words_equal_a_plain_count(spark, monkeypatch):
    dice, texts, labels = random.Random(9), [], []
    for _ in range(400):
        words = set(dice.sample(range(12), 5))
        texts.append(sorted(words))
        labels.append(int((3 in words) != (7 in words)) if dice.random() < 0.9 else dice.randrange(2))
    mean, want = sum(labels) / len(labels), set()
    for i in range(12):
        for j in range(12):
            cell = {(a, b): [y for t, y in zip(texts, labels) if ((i in t), (j in t)) == (a, b)]
                    for a in (True, False) for b in (True, False)}
            if min(len(c) for c in cell.values()) < toxicity.PAIR_CELL:
                continue
            rate = {k: sum(c) / len(c) for k, c in cell.items()}
            gap = rate[True, True] - rate[True, False] - rate[False, True] + rate[False, False]
            if abs(gap) >= 6 * (mean * (1 - mean) * sum(1 / len(c) for c in cell.values())) ** 0.5:
                want.add(i)
    monkeypatch.setattr(toxicity, "PAIR_BLOCK", 5)
    monkeypatch.setattr(toxicity, "PAIR_SLAB", 64)
    examples = spark.createDataFrame(list(zip(labels, texts)), "label int, words array<int>")
    found = [r["hash"] for r in toxicity.pair_words(examples).collect()]
    assert {3, 7} <= want and sorted(found) == sorted(want)
    assert toxicity.pair_words(examples.limit(0)).count() == 0


def test_awkward_rows_and_no_labels(spark):
    docs = clashing(awkward(spark), "score", "label", "weight")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, toxicity.train(docs, none)).collect()
    assert len(scored) == docs.count() and {r["score"] for r in scored} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    trained = toxicity.train(docs, labels, folds=1, fold=5)
    scored = toxicity.with_toxicity(docs, trained).collect()
    assert all(0 <= r["score"] <= 1 and r["label"] == "taken" for r in scored)
    assert len({r["score"] for r in scored if not (r["text"] or "").strip()}) == 1
    assert toxicity.with_toxicity(docs.limit(0), trained).count() == 0
    assert toxicity.drop_toxic(docs, none, 0.6).columns == docs.columns


def test_held_out_documents(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = rows(op5_factorization_toxicity(spark, SMALL), "doc_id", "held_out", "score", "predicted")
    assert all(r[1] == (fold(r[0], 4) == 2) and r[3] == (r[2] >= 0.3) for r in found)
    held = [r for r in found if r[1] and r[0] in toxic]
    caught = [r[3] for r in held if toxic[r[0]]]
    false = [r[3] for r in held if not toxic[r[0]]]
    assert sum(caught) >= 0.8 * len(caught) and sum(false) <= 0.02 * len(false)
