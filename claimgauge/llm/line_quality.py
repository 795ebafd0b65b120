"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. A line's features are its own and those of the
lines before and after it; transitions between states are learnt. The forward-backward
marginals of the lines, weighted by their lengths, make the quality of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import fold_labels, labelled_sample, written
from claimgauge.llm.training import fit

#: Fold kept from learning: crc32(doc_id) mod 5 = 0.
FOLDS, FOLD = 5, 0
#: Bound of the labelled sample, half of it of low quality where there are enough.
SAMPLE_ROWS = 4_000
STEPS = 60
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_BEYOND = bytes(range(128, 256))
_SPACE = b" \t\x0b\f\r"
_STOP = b".,;:?'\"-()"
#: Features of one line; ``_features`` gives them in this order.
OWN = ("upper", "symbols", "digits", "stops", "beyond_ascii", "short", "long", "word_length",
       "distinct", "all_same", "neighbours_equal", "repeated", "ends_sentence", "shouts")
WIDTH = len(OWN)
#: Weights of the bad state: bias, own features, those of the line before and after (zeros
#: at the ends); then the transition scores good-bad, bad-good and bad-bad.
PARAMETERS = 1 + 3 * WIDTH + 3


def _features(line: bytes, earlier: set[bytes]) -> list[float]:
    size = len(line)
    count = lambda some: size - len(line.translate(None, some))
    upper, lower, digits, beyond = count(_UPPER), count(_LOWER), count(_DIGIT), count(_BEYOND)
    stops, space = count(_STOP), count(_SPACE)
    symbols = size - upper - lower - digits - beyond - stops - space
    words = line.split()
    n, kinds = len(words), len(set(words))
    shown = size - space
    return [upper / size, min(1.0, 4 * symbols / shown), digits / shown, stops / shown, beyond / size,
            float(n < 4), min(1.0, size / 2000), min(1.0, shown / n / 12), kinds / n,
            float(n > 3 and kinds < 0.5 * n), sum(map(eq, words, words[1:])) / n,
            float(line in earlier), float(line.rstrip()[-1:] in (b".", b"!", b"?")),
            float(upper > lower)]


def line_table(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x ``WIDTH``) and byte lengths of the lines that are not blank."""
    earlier: set[bytes] = set()
    rows, sizes = [], []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        if line.strip():
            rows.append(_features(line, earlier))
            sizes.append(len(line))
            earlier.add(line)
    return np.array(rows).reshape(-1, WIDTH), np.array(sizes, float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    return np.hstack([np.ones((len(own), 1)), own, before, after])


def _batches(lengths: np.ndarray, cells: int = 100_000) -> Iterator[np.ndarray]:
    """Documents of like length together, at most ``cells`` lines with padding (or one)."""
    order, at = np.argsort(lengths, kind="stable"), 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * lengths[order[end]] <= cells:
            end += 1
        yield order[at:end]
        at = end


def marginals(scores: list[np.ndarray], steps: np.ndarray, pairs: bool = False):
    """Per document the probability of each line to be bad; with ``pairs`` also the
    expected transitions (good-bad, bad-good, bad-bad) and log Z of every document.

    ``scores``: bad-state scores of the lines; ``steps``: the three transition scores.
    """
    lengths = np.array([len(s) for s in scores])
    bad: list = [np.empty(0)] * len(scores)
    moves, norms = np.zeros((len(scores), 3)), np.zeros(len(scores))
    move = np.array([[0.0, steps[0]], [steps[1], steps[2]]])
    for batch in _batches(lengths):
        long = int(lengths[batch].max())
        if not long:
            continue
        emit = np.zeros((len(batch), long))
        for i, d in enumerate(batch):
            emit[i, :lengths[d]] = scores[d]
        real = np.arange(long) < lengths[batch][:, None]
        ahead = np.zeros((len(batch), long, 2))
        ahead[:, 0, 1] = emit[:, 0]
        for t in range(1, long):
            grown = np.logaddexp(ahead[:, t - 1, None, 0] + move[0], ahead[:, t - 1, None, 1] + move[1])
            grown[:, 1] += emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], grown, ahead[:, t - 1])
        back = np.zeros((len(batch), long, 2))
        for t in range(long - 2, -1, -1):
            onward = back[:, t + 1] + np.stack([np.zeros(len(batch)), emit[:, t + 1]], axis=1)
            value = np.logaddexp(onward[:, None, 0] + move[:, 0], onward[:, None, 1] + move[:, 1])
            back[:, t] = np.where(real[:, t + 1, None], value, 0.0)
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        share = np.exp(np.minimum(0, ahead[:, :, 1] + back[:, :, 1] - norm[:, None]))
        for i, d in enumerate(batch):
            bad[d] = share[i, :lengths[d]]
        norms[batch] = norm
        if pairs and long > 1:
            onward = back[:, 1:] + np.stack([np.zeros_like(emit[:, 1:]), emit[:, 1:]], axis=2)
            for k, (i, j) in enumerate(((0, 1), (1, 0), (1, 1))):
                joint = np.exp(np.minimum(0, ahead[:, :-1, i] + move[i, j] + onward[:, :, j]
                                          - norm[:, None, ]))
                moves[batch, k] = (joint * real[:, 1:]).sum(axis=1)
    return (bad, moves, norms) if pairs else bad


def _slope(values: np.ndarray, tables: list[np.ndarray], labels: np.ndarray, weights: np.ndarray):
    """Negative log-likelihood and its gradient, every line of a document labelled as the
    document is (1: good); documents count alike, however many lines they have."""
    inputs = [with_neighbours(t) for t in tables]
    bad, moves, norms = marginals([x @ values[:-3] for x in inputs], values[-3:], pairs=True)
    loss, slope = 0.0, np.zeros(len(values))
    for x, p, move, norm, label, weight in zip(inputs, bad, moves, norms, labels, weights):
        n = len(x)
        if not n:
            continue
        truth = 1.0 - label
        steps = np.array([0.0, 0.0, (n - 1) * truth])
        gold = truth * ((x @ values[:-3]).sum() + (n - 1) * values[-1])
        loss += weight * (norm - gold) / n
        slope[:-3] += weight / n * ((p - truth) @ x)
        slope[-3:] += weight / n * (move - steps)
    return loss, slope


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", folds: int = FOLDS,
          fold: int = FOLD, rows: int = SAMPLE_ROWS, steps: int = STEPS) -> np.ndarray:
    """Parameters learnt from at most ``rows`` labelled texts; zeros (every score 0.5)
    without any."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def flat(texts: pd.Series) -> pd.Series:
        return pd.Series([line_table(t)[0].ravel().astype("float32") for t in texts])

    sample = labelled_sample(docs, fold_labels(labels, target, folds, fold), [0, 1], rows)
    examples = written(sample.select("label", "weight", flat("text").alias("lines")), "quality-lines")

    def gradient(values: np.ndarray, frames: Iterator[pd.DataFrame]):
        loss, slope = 0.0, np.zeros(len(values))
        for frame in frames:
            tables = [np.asarray(x, float).reshape(-1, WIDTH) for x in frame["lines"]]
            more = _slope(values, tables, frame["label"].to_numpy(), frame["weight"].to_numpy())
            loss, slope = loss + more[0], slope + more[1]
        return loss, slope

    return fit(examples, gradient, np.zeros(PARAMETERS), steps, 0.25, 1e-4)


def line_marginals(text: str | None, values: np.ndarray) -> list[tuple[int, float]]:
    """Byte length and probability of being good of each line that is not blank."""
    own, sizes = line_table(text)
    bad = marginals([with_neighbours(own) @ values[:-3]], values[-3:])[0]
    return [(int(s), float(1 - p)) for s, p in zip(sizes, bad)]


def with_quality(docs: DataFrame, values: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` plus the length-weighted probability of its lines to be good.

    A text without a line that is not blank (null, empty) scores 0. Equal texts score
    alike; a column called ``name`` is replaced; only ``text`` is read.
    """
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        found = []
        for at in range(0, len(texts), 256):
            tables = [line_table(t) for t in texts.iloc[at:at + 256]]
            bad = marginals([with_neighbours(own) @ values[:-3] for own, _ in tables], values[-3:])
            found += [float(((1 - p) * s).sum() / s.sum()) if len(s) else 0.0
                      for p, (_, s) in zip(bad, tables)]
        return pd.Series(found, dtype=float).clip(0, 1)

    return docs.withColumn(name, score(F.col("text")))
