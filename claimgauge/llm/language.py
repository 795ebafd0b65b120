"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of orders 3 to 0 is counted once and then
frozen. The code length of a text under a language is exact: a byte seen after the
longest known context costs its share there; otherwise an escape is paid (method C: as
many escapes as distinct bytes seen) and the next shorter context is asked, without the
bytes already ruled out; after order 0 all unseen bytes cost the same. The language
with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import may_learn

#: Fold kept from learning: crc32(doc_id) mod 5 = 0.
FOLDS, FOLD = 5, 0
#: Bound of the texts learnt from, per language.
SAMPLE_ROWS = 1_000
ORDER = 3
UNDETERMINED = "und"
#: Bytes worked on at once.
PIECE = 1 << 20
#: A text is taken to follow this many line ends, so every byte has a full context.
_PAD = b"\n" * ORDER


def grams(data: np.ndarray) -> np.ndarray:
    """4-byte windows (context and byte) ending at each byte from the fourth on."""
    wide = data.astype(np.uint32)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


def _count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            for text in texts:
                data = np.frombuffer(_PAD + text.encode("utf-8", "surrogatepass"), np.uint8)
                for at in range(0, len(data) - ORDER, PIECE):
                    keys, n = np.unique(grams(data[at:at + PIECE + ORDER]), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": n})


class Tree:
    """Frozen contexts of one language. ``grams[k]``/``counts[k]``: context of k bytes plus
    byte; ``contexts[k]`` with ``full`` (events plus escapes) and ``escapes``, and the same
    two for the next shorter context once the bytes seen here are ruled out."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.grams, self.counts, self.contexts = [None] * 4, [None] * 4, [None] * 4
        self.full, self.escapes, self.after = [None] * 4, [None] * 4, [None] * 4
        for k in range(ORDER, -1, -1):
            cut = np.uint32((1 << 8 * (k + 1)) - 1)
            kept, where = np.unique(keys & cut, return_inverse=True)
            n = np.bincount(where, counts, len(kept)).astype(np.int64)
            contexts, start = np.unique(kept >> np.uint32(8), return_index=True)
            escapes = np.diff(np.append(start, len(kept)))
            self.grams[k], self.counts[k], self.contexts[k] = kept, n, contexts
            self.full[k] = np.add.reduceat(n, start) + escapes
            self.escapes[k] = escapes
        for k in range(ORDER, 0, -1):
            shorter = self.grams[k] & np.uint32((1 << 8 * k) - 1)
            ruled_out = self.counts[k - 1][np.searchsorted(self.grams[k - 1], shorter)]
            starts = np.cumsum(self.escapes[k]) - self.escapes[k]
            parent = np.searchsorted(self.contexts[k - 1], shorter[starts] >> np.uint32(8))
            left = self.escapes[k - 1][parent] - self.escapes[k]
            events = self.full[k - 1][parent] - self.escapes[k - 1][parent]
            self.after[k] = (events - np.add.reduceat(ruled_out, starts) + left, left)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths of the last bytes of 4-byte windows after their first three."""
        bits, open_ = np.zeros(len(keys)), np.arange(len(keys))
        full, escapes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        escaped = np.zeros(len(keys), bool)
        for k in range(ORDER, -1, -1):
            own = keys[open_] & np.uint32((1 << 8 * (k + 1)) - 1)
            context = own >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            met = self.contexts[k][at] == context
            fresh = met & ~escaped[open_]
            full[open_[fresh]] = self.full[k][at[fresh]]
            escapes[open_[fresh]] = self.escapes[k][at[fresh]]
            gram = np.minimum(np.searchsorted(self.grams[k], own), len(self.grams[k]) - 1)
            seen = self.grams[k][gram] == own
            done = open_[seen]
            bits[done] += np.log2(full[done]) - np.log2(self.counts[k][gram[seen]])
            paid = open_[met & ~seen]
            costly = paid[escapes[paid] > 0]
            bits[costly] += np.log2(full[costly]) - np.log2(escapes[costly])
            if k:
                full[paid], escapes[paid] = (x[at[met & ~seen]] for x in self.after[k])
                escaped[paid] = True
            open_ = open_[~seen]
        bits[open_] += np.log2(256 - len(self.grams[0]))
        return bits


class LanguageModel:
    """The trees of all languages, and a hash table of the code lengths of the windows
    that any of them has seen."""

    def __init__(self, counted: pd.DataFrame):
        self.languages = sorted(counted["lang"].unique())
        by = dict(tuple(counted.groupby("lang")))
        self.trees = [Tree(by[x]["gram"].to_numpy().astype(np.uint32), by[x]["n"].to_numpy())
                      for x in self.languages]
        keys = np.unique(counted["gram"].to_numpy().astype(np.uint32))
        self.shift = np.uint32(32 - max(4, int(4 * len(keys)).bit_length()))
        self.row = np.full((1 << int(32 - self.shift)) + 1, -1, np.int32)
        self.key = np.zeros(len(self.row), np.uint32)
        self.costs = np.stack([t.bits(keys) for t in self.trees], axis=1).astype(np.float32) \
            if self.trees else np.zeros((0, 0), np.float32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.row[slot] < 0
            self.row[slot[free]] = left[free]
            won = self.row[slot] == left
            self.key[slot[won]] = keys[left[won]]
            slot, left = (slot[~won] + 1) % (len(self.row) - 1), left[~won]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def _costs_of(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths of windows (windows x languages)."""
        slot = self._slots(keys)
        row = self.row[slot]
        astray = np.flatnonzero((row >= 0) & (self.key[slot] != keys))
        while len(astray):
            slot[astray] = (slot[astray] + 1) % (len(self.row) - 1)
            row[astray] = self.row[slot[astray]]
            astray = astray[(row[astray] >= 0) & (self.key[slot[astray]] != keys[astray])]
        costs = self.costs[row]
        if (row < 0).any():
            unseen, where = np.unique(keys[row < 0], return_inverse=True)
            costs[row < 0] = np.stack([t.bits(unseen) for t in self.trees], axis=1)[where]
        return costs

    def code_lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits of every whole text under every language (texts x languages)."""
        bits = np.zeros((len(texts), len(self.languages)))
        if not self.languages:
            return bits
        pieces: list[bytes] = []
        owners: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            data = _PAD + (text or "").encode("utf-8", "surrogatepass")
            for at in range(0, len(data) - ORDER, PIECE):
                pieces.append(data[at:at + PIECE + ORDER])
                owners.append(i)
                held += len(pieces[-1])
                if held >= PIECE:
                    self._add(bits, pieces, owners)
                    pieces, owners, held = [], [], 0
        self._add(bits, pieces, owners)
        return bits

    def _add(self, bits: np.ndarray, pieces: list[bytes], owners: list[int]) -> None:
        if not pieces:
            return
        costs = self._costs_of(grams(np.frombuffer(b"".join(pieces), np.uint8)))
        ends = np.cumsum([len(p) for p in pieces])
        # Windows that reach over from one piece into the next lie between the pieces' own.
        cuts = np.stack([np.append(0, ends[:-1]), ends - ORDER], axis=1).ravel()
        sums = np.add.reduceat(costs, cuts[:-1], axis=0, dtype=np.float64)[::2]
        np.add.at(bits, owners, sums)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, folds: int = FOLDS,
          fold: int = FOLD) -> LanguageModel:
    """Trees learnt from at most ``rows`` texts of every non-null ``lang``: those of least
    hash of their ids in the learning folds. The windows and counts of that bounded
    sample, not texts, come to the driver."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("id"), "lang", F.xxhash64("text").alias("hash"),
                      "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                                    & may_learn(F.col("doc_id"), folds, fold))
    # Only the rows of low hash, some two times ``rows`` of each language, are ranked: a
    # language that most texts have is no more work for its task than a rare one.
    slim, place = own.select("lang", "id", "hash"), F.xxhash64("id", F.lit(23))
    counts = slim.groupBy("lang").agg(F.count("*").alias("n"))
    low = F.pmod(place, F.lit(1 << 40)) * F.col("n") < 2.0 * rows * (1 << 40)
    order = Window.partitionBy("lang").orderBy(place, "id", "hash")
    ids = (slim.join(counts, "lang").where(low).select("lang", "id", "hash").distinct()
           .withColumn("n", F.row_number().over(order))
           .where(F.col("n") <= rows).select("lang", "id", "hash"))
    # ``rows`` ids per language of 40 bytes each: bounded by the parameter. Of repeated rows
    # one is learnt from.
    picked = (own.join(F.broadcast(ids), ["lang", "id", "hash"])
              .dropDuplicates(["lang", "id", "hash"]).select("lang", "text"))
    counted = (picked.mapInPandas(_count_grams, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    return LanguageModel(counted.toPandas())


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the posterior of the language under equal
    priors (0 to 1); columns of these names are replaced.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learnt. Of
    languages with equal code lengths the first in alphabetical order is taken. Only
    ``text`` is read.
    """
    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()),
                                T.StructField("score", T.DoubleType())]))
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = [], []
        for at in range(0, len(texts), 1024):
            part = list(texts.iloc[at:at + 1024])
            bits = model.code_lengths(part)
            for text, row in zip(part, bits):
                known = text is not None and len(row) and any(map(str.isalpha, text))
                best = int(row.argmin()) if known else -1
                langs.append(model.languages[best] if known else UNDETERMINED)
                scores.append(float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum())
                              if known else 0.0)
        return pd.DataFrame({"lang": langs, "score": scores})

    found = docs.withColumn("__found", predict(F.col("text")))
    return found.withColumns({"lang_pred": F.col("__found.lang"),
                              "score": F.col("__found.score")}).drop("__found")


