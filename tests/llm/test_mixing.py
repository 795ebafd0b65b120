import numpy as np
from pyspark.sql import functions as F

from claimgauge.llm import mixing as m
from claimgauge.llm.queries import op9_soft_mixing
from tests.llm.helpers import awkward, clashing, documents

SMALL = "/root/testdata/sf0.01"


def members(spark, rows):
    return spark.createDataFrame([(t, *p) for t, p in rows], "tokens long, p_a double, p_b double, p_c double")


def test_rates_meet_the_targets(spark):
    dice = np.random.default_rng(1)
    rows = [(int(t), tuple(map(float, p))) for t, p in zip(
        dice.integers(10, 500, 400), dice.dirichlet([4, 0.3, 0.3], 400))]
    frame = members(spark, rows)
    targets = {"a": 0.8, "b": 0.12, "c": 0.08}
    found = m.with_rates(frame, targets, steps=30, tolerance=1e-6).collect()
    have = np.array([sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in found) for d in "abc"])
    mass = sum(r["tokens"] * r["p_a"] for r in found)
    assert min(r["rate"] for r in found) >= 0
    assert np.allclose(have / (m.HEADROOM * mass / 0.8), [0.8, 0.12, 0.08], rtol=0.05)


def test_rates_stay_at_zero_where_the_gradient_pushes_below(spark):
    frame = members(spark, [(100, (1.0, 0.0, 0.0)), (100, (0.0, 1.0, 0.0)), (50, (0.0, 0.0, 1.0))])
    rates = [r["rate"] for r in m.with_rates(
        frame, {"a": 0.9, "b": 0.1, "c": 0.0}, headroom=1.0).collect()]
    assert np.allclose(rates, [1.0, 100 / 0.9 * 0.1 / 100, 0.0], atol=2e-3)


def test_no_tokens(spark):
    frame = members(spark, [(0, (0.5, 0.5, 0.0))])
    assert m.with_rates(frame, {"a": 0.5, "b": 0.5}).first()["rate"] == 1.0


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "tokens", "rate", "label", "words")
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, 1, 0), (None, 0, 0), (2, None, 1)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("doc_id = 1")):
        found = m.mix(docs, m.domain_labels(known)).collect()
        assert len(found) == docs.count()
        assert all(abs(r["p_prose"] + r["p_junk"] - 1) < 1e-5 and r["rate"] >= 0 for r in found)
        assert len({(r["rate"], r["copies"]) for r in found if r["__id"] == 1 and r["tokens"] == 6}) == 1
    mixed = m.mixed(docs, m.domain_labels(labels))
    assert mixed.columns == docs.columns
    assert m.mix(docs.limit(0), m.domain_labels(labels)).count() == 0


def test_copies_average_to_the_rate(spark):
    docs = documents(spark, [(i, f"some words of text {i}") for i in range(3000)])
    found = m.mix(docs, spark.createDataFrame([(0, "prose")], "doc_id long, label string"), {"prose": 1.0}, 1.4)
    rate, copies = found.agg(F.avg("rate"), F.avg("copies")).first()
    assert abs(rate - 1.4) < 0.01 and abs(copies - 1.4) < 0.04


def test_query_meets_its_targets_and_keeps_prose(spark):
    found = op9_soft_mixing(spark, SMALL).toPandas()
    have = {d: (found["tokens"] * found["rate"] * found[f"p_{d}"]).sum() for d in m.TARGETS}
    total = sum(have.values())
    assert all(abs(have[d] / total - share) < 0.01 for d, share in m.TARGETS.items())
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    prose = found.merge(labels[labels["quality"] == 1], on="doc_id")
    junk = found.merge(labels[labels["quality"] == 0], on="doc_id")
    assert (prose["copies"] >= 1).mean() > 0.97 > 0.9 > (junk["copies"] >= 1).mean()
