import itertools

import numpy as np

from claimgauge.llm import line_quality
from claimgauge.llm.queries import op10_line_quality
from tests.llm.helpers import awkward, clashing, fold, rows

SMALL = "/root/testdata/sf0.01"


def by_enumeration(scores, steps):
    """Marginals, expected transitions and log Z over all labellings."""
    move = [[0.0, steps[0]], [steps[1], steps[2]]]
    n, weights = len(scores), {}
    for path in itertools.product((0, 1), repeat=n):
        total = sum(s for s, y in zip(scores, path) if y) + sum(move[a][b] for a, b in zip(path, path[1:]))
        weights[path] = np.exp(total)
    z = sum(weights.values())
    bad = [sum(w for p, w in weights.items() if p[t]) / z for t in range(n)]
    moves = [sum(w * sum((a, b) == kind for a, b in zip(p, p[1:])) for p, w in weights.items()) / z
             for kind in ((0, 1), (1, 0), (1, 1))]
    return bad, moves, np.log(z)


def test_marginals_equal_enumeration():
    dice = np.random.default_rng(2)
    scores = [dice.normal(size=n) for n in (1, 5, 2, 8, 0, 3)]
    steps = dice.normal(size=3)
    bad, moves, norms = line_quality.marginals(scores, steps, pairs=True)
    for s, p, m, z in zip(scores, bad, moves, norms):
        if len(s):
            want = by_enumeration(s, steps)
            assert np.allclose(p, want[0]) and np.allclose(m, want[1]) and np.isclose(z, want[2])
        else:
            assert len(p) == 0


def test_slope_is_the_derivative_of_the_loss():
    dice = np.random.default_rng(3)
    tables = [dice.random((n, line_quality.WIDTH)) for n in (1, 4, 3)]
    labels, weights = np.array([1, 0, 1]), np.array([1.0, 0.5, 2.0])
    values = dice.normal(size=line_quality.PARAMETERS) * 0.3
    slope = line_quality._slope(values, tables, labels, weights)[1]
    for k in [0, 3, 20, 40, line_quality.PARAMETERS - 3, line_quality.PARAMETERS - 2, line_quality.PARAMETERS - 1]:
        step = np.zeros_like(values)
        step[k] = 1e-6
        up, down = (line_quality._slope(values + s, tables, labels, weights)[0] for s in (step, -step))
        assert np.isclose((up - down) / 2e-6, slope[k], atol=1e-5)


def test_awkward_rows_and_no_labels(spark):
    docs = clashing(awkward(spark), "score", "label", "lines")
    none = spark.createDataFrame([], "doc_id long, quality int")
    values = line_quality.train(docs, none)
    assert not values.any()
    scored = line_quality.with_quality(docs, values).collect()
    assert len(scored) == docs.count()
    assert {r["score"] for r in scored if not (r["text"] or "").strip()} == {0.0}
    assert {round(r["score"], 9) for r in scored if (r["text"] or "").strip()} == {0.5}
    assert line_quality.with_quality(docs.limit(0), values).count() == 0


def test_lines_weigh_by_length(spark):
    values = np.zeros(line_quality.PARAMETERS)
    values[1 + line_quality.OWN.index("shouts")] = 50.0
    values[0] = -25.0
    text = "quiet words here\nLOUD\n\n"
    assert [(n, round(p, 6)) for n, p in line_quality.line_marginals(text, values)] == [(16, 1.0), (4, 0.0)]
    frame = spark.createDataFrame([(text,)], "text string")
    assert round(line_quality.with_quality(frame, values).first()["score"], 6) == 0.8


def test_held_out_documents(spark):
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = rows(op10_line_quality(spark, SMALL), "doc_id", "held_out", "score", "predicted")
    assert all(r[1] == (fold(r[0], 5) == 0) and r[3] == (r[2] >= 0.3) for r in found)
    held = [(quality[r[0]], r[3]) for r in found if r[1] and r[0] in quality]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
