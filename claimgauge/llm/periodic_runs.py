"""Periodic runs of words by the branching-tandem test on enhanced suffix arrays.

The suffixes of a batch of whole texts are ordered by prefix doubling (texts never
compare equal to one another). A run of period q that ends before word e has its last
square at i = e - 2q, and suffixes i and i + q agree in exactly q words: they lie in
different children of an LCP interval of depth q. So for each LCP interval the suffixes of
the smaller child are taken and ISA[i + depth], ISA[i - depth] are looked up in the rest of
the interval; the children are slices of the suffix array between neighbouring minima, no
tree is built. Squares found are rotated to the left as far as their period holds, which
gives the whole run, and squares of the same run are merged into its smallest period.
All arrays are as long as the batch, but for the ranks of each doubling: memory is about
``4 n log2 n`` bytes for texts of n words that repeat themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import let, words_of

#: A run has at least so many words, and holds its period so many times.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: Two suffixes of a run a period apart agree in so many words at least:
#: max(24, 3q) - q is 16 for q = 8 and more for any other q.
LEAST_SHARED = 16
#: Words of one suffix array; a longer text is taken alone.
BATCH_WORDS = 400_000

FOUND = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("period", T.LongType())])


def _doubled(ids: np.ndarray, text: np.ndarray, ends: np.ndarray, words: int | None = None):
    """Suffix array, whether each slot differs from the one before, and the ranks of every
    doubling; ``words`` stops once so many words are told apart."""
    n = len(ids)
    key = text * (np.int64(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    ranks, shared = [rank], 1
    while words is None or shared < words:
        slots = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))
        if not len(slots):
            break
        at = order[slots]
        after = at + shared
        second = np.where(after < ends[at], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + second
        by = np.argsort(key)
        key, at = key[by], at[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        order[slots], fresh[slots] = at, new
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        if words is None:
            ranks.append(rank)
        shared *= 2
    return order, fresh, ranks


def _lcp(order: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Words that slot k and the slot before agree in; 0 for the first."""
    a, b = order[:-1].copy(), order[1:].copy()
    stop_a, stop_b, last = ends[a], ends[b], len(order) - 1
    shared = np.zeros(len(a), np.int64)
    for level in reversed(range(len(ranks))):
        rank, step = ranks[level], 1 << level
        same = (a < stop_a) & (b < stop_b) & (rank[np.minimum(a, last)] == rank[np.minimum(b, last)])
        a[same] += step
        b[same] += step
        shared[same] += step
    return np.concatenate([[0], shared])


def _nearest(values: np.ndarray, asked: np.ndarray, below: bool) -> np.ndarray:
    """For each asked index the nearest one to the left whose value is less (``below``) or
    not more; pointers over larger values are followed all at once until they stop."""
    back = np.arange(-1, len(values) - 1)
    pending = np.arange(1, len(values))
    while len(pending):
        over = values[back[pending]]
        wrong = (over >= values[pending]) if below else (over > values[pending])
        pending = pending[wrong & (back[pending] >= 0)]
        back[pending] = back[back[pending]]
    return back[asked]


def _squares(order: np.ndarray, lcp: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Places and periods of branching squares, from the smaller children of all intervals."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    room = (ends - starts)[order]
    asked = np.flatnonzero((lcp > 0) & (lcp * LEAST_TIMES <= room))
    # Neighbours of equal depth belong to one interval: the first of them parts its first
    # child from all others, the next one its second child from those behind, and so on.
    left = _nearest(lcp, asked, below=False)
    right = n - 1 - _nearest(lcp[::-1].copy(), n - 1 - asked, below=True)
    depth = lcp[asked]
    first_is_smaller = asked - left <= right - asked
    low = np.where(first_is_smaller, left, asked)
    count = np.where(first_is_smaller, asked, right) - low
    other_low = np.where(first_is_smaller, asked, left)
    other_high = np.where(first_is_smaller, right, asked)
    bounds, at, found = np.concatenate([[0], np.cumsum(count)]), 0, []
    while at < len(asked):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 4_000_000, "right")) - 1)
        part = slice(at, to)
        node = np.repeat(np.arange(at, to), count[part])
        slot = low[node] + np.arange(len(node)) - (bounds[node] - bounds[at])
        i, d = order[slot], depth[node]
        for square, partner, inside in ((i, i + d, i + d < ends[i]), (i - d, i - d, i - d >= starts[i])):
            where = place[np.clip(partner, 0, n - 1)]
            hit = inside & (where >= other_low[node]) & (where < other_high[node])
            found.append((square[hit], d[hit]))
        at = to
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _rotated(ids: np.ndarray, begin: int, at: int, period: int) -> int:
    """The least place from which the period holds up to ``at`` without a break."""
    step = 64
    while at > begin:
        low = max(begin, at - step)
        broken = np.flatnonzero(ids[low:at] != ids[low + period:at + period])
        if len(broken):
            return low + int(broken[-1]) + 1
        at, step = low, step * 2
    return at


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)``, in order, of each text of a batch that has any.
    ``ids`` holds the words of all texts as integers, ``lengths`` their numbers of words."""
    runs: dict[int, list] = {}
    if not len(ids):
        return runs
    # Texts whose suffixes all differ within 16 words have no run and are done.
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    order, fresh, _ = _doubled(ids, text, ends, words=LEAST_SHARED)
    alike = np.zeros(len(lengths), bool)
    alike[text[order[~fresh]]] = True
    if not alike.any():
        return runs
    ids, numbers, lengths = ids[alike[text]], np.flatnonzero(alike), lengths[alike]
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    starts = ends - np.repeat(lengths, lengths)
    order, _, ranks = _doubled(ids, text, ends)
    at, period = _squares(order, _lcp(order, ranks, ends), starts, ends)
    # Every run needs eight words or more to the left of its last square.
    for t in range(1, 9):
        keep = at - t >= starts[at]
        at, period = at[keep], period[keep]
        keep = ids[at - t] == ids[at - t + period]
        at, period = at[keep], period[keep]
    stop = at + 2 * period
    by = np.lexsort((period, stop))
    known: dict[int, list] = {}
    for i, q, e in zip(at[by].tolist(), period[by].tolist(), stop[by].tolist()):
        if any(q % p == 0 and 2 * q <= e - s for s, p in known.get(e, ())):
            continue  # another square of a run whose smallest period is known
        s = _rotated(ids, int(starts[i]), i, q)
        if e - s >= max(LEAST_WORDS, LEAST_TIMES * q):
            known.setdefault(e, []).append((s, q))
            begin = int(starts[i])
            runs.setdefault(int(numbers[text[i]]), []).append((s - begin, e - s, q))
    return {k: sorted(v, key=lambda run: (run[0], run[2])) for k, v in runs.items()}


def _batches(texts: list[bytes | None], limit: int) -> Iterator[tuple[list, dict]]:
    """Words of each text, and the runs by place in the batch."""
    def settled(batch: list) -> tuple[list, dict]:
        flat = np.empty(sum(map(len, batch)), object)
        flat[:] = [w for words in batch for w in words]
        ids = pd.factorize(flat)[0].astype(np.int64)
        return batch, find_runs(ids, np.array([len(w) for w in batch], np.int64))

    batch, size = [], 0
    for text in texts:
        words = (text or b"").split()  # bytes split at just the six white-space characters
        if batch and size + len(words) > limit:
            yield settled(batch)
            batch, size = [], 0
        batch.append(words)
        size += len(words)
    if batch:
        yield settled(batch)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by single spaces."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def with_runs(docs: DataFrame, text_column: str = "text",
              batch_words: int = BATCH_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of ``start``, ``length``, ``period``, by start
    and period) and ``collapsed`` (the text without what its runs repeat, words joined by
    one space); columns of these names are replaced, ``text_column`` excepted.

    A run is a longest stretch of words with a smallest period, at least 24 words and three
    periods long. Null, empty and blank texts have no words and no runs, and an empty
    ``collapsed``. Rows are judged one by one, so repeated rows and ids get the same answer
    and an empty table stays empty. A text is never cut; one longer than ``batch_words``
    makes a suffix array of its own.
    """
    new = ["n_words", "runs", "collapsed"]
    if text_column in new:
        raise ValueError(f"{text_column} is one of the columns to be added")
    carried = docs.drop(*new)
    schema = T.StructType([*carried.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(FOUND)),
                           T.StructField("collapsed", T.StringType())])
    at = carried.columns.index(text_column)

    def judged(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = frame.column(at).cast(pa.binary()).to_pylist()
            counts, found, left = [], [], []
            for batch, runs in _batches(texts, batch_words):
                for k, words in enumerate(batch):
                    own = runs.get(k, [])
                    counts.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    left.append(_collapsed(words, own))
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, pa.array(counts, pa.int64()), pa.array(found, kind),
                 pa.array(left, pa.binary()).cast(pa.string())], names=[f.name for f in schema])

    return carried.mapInArrow(judged, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length over period; of equal ones the first. Null if there is none."""
    return F.reduce(runs, F.get(runs, 0), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def planted(text: Column, doc_id: Column) -> Column:
    """The text of the contract: for one id in ten the words from some place on repeat."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda word, i: F.when(i < a, word).otherwise(
            F.get(words, (a + (i - a) % p).cast("int")))), " ")

    return F.when((h % 10 == 0) & (F.size(words_of(text)) > 0),
                  let(words_of(text), repeated)).otherwise(text)
