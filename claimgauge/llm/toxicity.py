"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words, and beginnings of words, so that inflected
forms share a term. Besides a weight each term has a short vector; the inner products of
the vectors score pairs of terms, such as an insult together with a group it is aimed
at, which neither term's weight shows alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import fold_labels, labelled_sample, written
from claimgauge.llm.training import fit

#: Fold kept from learning: crc32(doc_id) mod 4 = 2.
FOLDS, FOLD = 4, 2
#: Bound of the labelled sample, half of it toxic where there are enough.
SAMPLE_ROWS = 6_000
SPACE = 1 << 20
#: A term takes part if this many sample texts have it, and its shares of toxic and other
#: texts are this many standard errors apart,
LEAST_TEXTS, LEAST_ERRORS = 4, 3.0
#: or if it is a word of this many sample texts that works together with another such word:
#: toxic shares of texts with both, either and none of the two do not add up, by this many errors.
PAIR_TEXTS, PAIR_CELL, PAIR_ERRORS = 30, 5, 6.0
#: Words a task of the search for pairs tries against all others, and texts it reads at a time.
PAIR_BLOCK, PAIR_SLAB = 256, 512
RANK = 4
STEPS = 80
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
_MEMO = 400_000

# Letters stay (all bytes above ASCII count as such), everything else parts words.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def hashed_word(word: bytes) -> int:
    return zlib.crc32(b"=" + word) % SPACE


def hashed_terms(word: bytes) -> set[int]:
    heads = [b"^" + word[:n] for n in PREFIXES if len(word) >= n]
    return {hashed_word(word), *(zlib.crc32(head) % SPACE for head in heads)}


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def term_reader(of_term: dict[int, int] | None = None) -> Callable[[str | None], list[int]]:
    """Reads texts to the sorted hashes of their terms, or to the indices of those that
    ``of_term`` has. Words met before are looked up in a memo of bounded size."""
    memo: dict[bytes, tuple[int, ...]] = {}

    def read(text: str | None) -> list[int]:
        if len(memo) > _MEMO:
            memo.clear()
        found: set[int] = set()
        for word in words_of(text):
            terms = memo.get(word)
            if terms is None:
                hashes = hashed_terms(word)
                terms = tuple(hashes if of_term is None
                              else (of_term[h] for h in hashes if h in of_term))
                memo[word] = terms
            if terms:
                found.update(terms)
        return sorted(found)

    return read


@dataclass
class FactorizationMachine:
    """``terms``: the hashes that count; ``values``: bias, weights, vectors in one array."""

    terms: np.ndarray
    values: np.ndarray
    rank: int = RANK

    def parts(self) -> tuple[float, np.ndarray, np.ndarray]:
        n = len(self.terms)
        return self.values[0], self.values[1:n + 1], self.values[n + 1:].reshape(n, self.rank)

    def margins(self, rows: list) -> np.ndarray:
        """Log-odds of texts given as lists of term indices."""
        return self._forward(*_flat(rows))[0]

    def _forward(self, flat, row, n):
        bias, weights, vectors = self.parts()
        linear = np.bincount(row, weights[flat], n)
        mine = vectors[flat]
        sums = np.stack([np.bincount(row, mine[:, k], n) for k in range(self.rank)], axis=1)
        squares = np.bincount(row, (mine ** 2).sum(axis=1), n)
        return bias + linear + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums

    def slope(self, rows: list, labels: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
        flat, row, n = _flat(rows)
        margin, sums = self._forward(flat, row, n)
        loss = float((weights * (np.logaddexp(0, margin) - labels * margin)).sum())
        error = weights * (_sigmoid(margin) - labels)
        size, vectors = len(self.terms), self.parts()[2]
        each = error[row]
        by_term = np.bincount(flat, each, size)
        pull = np.stack([np.bincount(flat, each * sums[row, k], size) for k in range(self.rank)],
                        axis=1) - vectors * by_term[:, None]
        return loss, np.concatenate([[error.sum()], by_term, pull.ravel()])


def _flat(rows: list) -> tuple[np.ndarray, np.ndarray, int]:
    lengths = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if len(rows) else np.empty(0, np.int64)
    return flat, np.repeat(np.arange(len(rows)), lengths), len(rows)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def pair_words(examples: DataFrame, least_texts: int = PAIR_TEXTS) -> DataFrame:
    """``hash`` of the words that work in a pair, whatever their single effects.

    ``examples`` has ``label`` and ``words`` (hashes) of a bounded sample. Each task takes a
    block of words and looks at their contrasts with the words of this block and the later ones:
    p11 - p10 - p01 + p00 over the four cells of texts that have both, one or none of them.
    No table of pairs is made.
    """
    counts = examples.select(F.explode("words").alias("hash")).groupBy("hash").count().where(
        F.col("count") >= least_texts)
    vocabulary = np.array(sorted(r["hash"] for r in counts.select("hash").collect()), np.int64)
    blocks = -(-len(vocabulary) // PAIR_BLOCK)

    def contrasts(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        later = vocabulary[key[0] * PAIR_BLOCK:]
        size, n_mine = len(later), min(PAIR_BLOCK, len(later))
        both, toxic_both = (np.zeros((n_mine, size), np.float32) for _ in range(2))
        all_, toxic = np.zeros(size), np.zeros(size)
        for at in range(0, len(sample), PAIR_SLAB):
            slab = sample.iloc[at:at + PAIR_SLAB]
            flat, row, n = _flat(list(slab["words"]))
            place = np.searchsorted(later, flat)
            known = later[np.minimum(place, size - 1)] == flat
            has = np.zeros((n, size), np.float32)
            has[row[known], place[known]] = 1
            bad = has[slab["label"].to_numpy() == 1]
            both += has[:, :n_mine].T @ has
            toxic_both += bad[:, :n_mine].T @ bad
            all_ += has.sum(axis=0)
            toxic += bad.sum(axis=0)
        total, total_bad = len(sample), float(sample["label"].sum())
        cells = [both, all_[:n_mine, None] - both, all_ - both]
        bad_in = [toxic_both, toxic[:n_mine, None] - toxic_both, toxic - toxic_both]
        cells.append(total - sum(cells))
        bad_in.append(total_bad - sum(bad_in))
        full = np.minimum.reduce(cells) >= PAIR_CELL
        one, left, right, none = (b / np.maximum(c, 1) for b, c in zip(bad_in, cells))
        overall = total_bad / total
        spread = np.sqrt(overall * (1 - overall) * sum(1 / np.maximum(c, 1) for c in cells))
        clear = np.abs(one - left - right + none) >= PAIR_ERRORS * spread
        found = full & clear & (spread > 0)
        hit = found.any(axis=0)
        hit[:n_mine] |= found.any(axis=1)
        return pd.DataFrame({"hash": later[hit].astype(np.int32)})

    tried = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks else F.explode(
        F.array().cast("array<int>"))
    return (examples.select("label", "words", tried.alias("block")).groupBy("block")
            .applyInPandas(contrasts, "hash int").distinct())


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", folds: int = FOLDS,
          fold: int = FOLD, rows: int = SAMPLE_ROWS, steps: int = STEPS) -> FactorizationMachine:
    """Machine learnt from at most ``rows`` labelled texts. All hashes take part whose share of
    texts differs between the labels, and all words that matter in a pair (``pair_words``), however
    they are spread over the labels by themselves. Without examples every text scores 0.5, with
    one label only close to that label."""
    sample = labelled_sample(docs, fold_labels(labels, target, folds, fold), [0, 1], rows)
    read = term_reader()
    hashes = F.pandas_udf(lambda texts: pd.Series([read(t) for t in texts]),
                          T.ArrayType(T.IntegerType()))
    whole = F.pandas_udf(lambda texts: pd.Series([sorted({hashed_word(w) for w in words_of(t)})
                                                  for t in texts]), T.ArrayType(T.IntegerType()))
    examples = written(sample.select("label", "weight", hashes("text").alias("hashes"),
                                     whole("text").alias("words")), "toxic-terms")
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    n = [max(1, sizes.get(x, 0)) for x in (0, 1)]
    used = examples.select("label", F.explode("hashes").alias("hash")).groupBy("hash").agg(
        F.sum("label").alias("in_one"), F.count("*").alias("all"))
    share = (F.col("in_one") / n[1] - (F.col("all") - F.col("in_one")) / n[0])
    overall = F.col("all") / sum(n)
    errors = F.abs(share) / F.sqrt(overall * (1 - overall / 2) * (1 / n[0] + 1 / n[1]))
    chosen = used.where((F.col("all") >= LEAST_TEXTS) & (errors >= LEAST_ERRORS)).select("hash")
    chosen = chosen.unionByName(pair_words(examples)).distinct()
    kept = np.array(sorted(r["hash"] for r in chosen.collect()), np.int64)
    start = np.concatenate([np.zeros(1 + len(kept)),
                            np.random.default_rng(5).normal(0, 0.02, len(kept) * RANK)])
    index = {int(h): i for i, h in enumerate(kept)}

    def gradient(values: np.ndarray, frames: Iterator[pd.DataFrame]):
        machine, loss, slope = FactorizationMachine(kept, values), 0.0, np.zeros(len(values))
        for frame in frames:
            rows = [[index[h] for h in r if h in index] for r in frame["hashes"]]
            more = machine.slope(rows, frame["label"].to_numpy(), frame["weight"].to_numpy())
            loss, slope = loss + more[0], slope + more[1]
        return loss, slope

    ridge = np.concatenate([[0.0], np.full(len(kept), 1e-4), np.full(len(kept) * RANK, 3e-4)])
    return FactorizationMachine(kept, fit(examples.drop("words"), gradient, start, steps, 0.1, ridge))


def with_toxicity(docs: DataFrame, machine: FactorizationMachine, name: str = "score") -> DataFrame:
    """``docs`` plus the probability that the text is toxic (double, 0 to 1).

    Null and empty texts have no terms and score by the bias alone; equal texts score
    alike. A column called ``name`` is replaced; no other column is read but ``text``.
    """
    index = {int(h): i for i, h in enumerate(machine.terms)}
    read = term_reader(index)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(_sigmoid(machine.margins([read(t) for t in texts])))

    return docs.withColumn(name, score(F.col("text")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more.

    Null and empty texts get the score of a text without terms and are judged by it. Rows
    alike in text stay or go together. An empty table stays empty; without labels nothing
    is learnt and the score is that of the bias alone. A column ``__toxic`` must not be there.
    """
    scored = with_toxicity(docs, train(docs, labels), "__toxic")
    return scored.where(F.col("__toxic") < threshold).drop("__toxic")
