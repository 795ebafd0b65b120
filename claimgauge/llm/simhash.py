"""SimHash near-duplicates by a Gray-order hierarchical index.

Distinct fingerprints that differ in at most ``distance`` bits are linked; documents of
one component are near-duplicates of each other.

How the work is dealt. Two fingerprints within 3 bits agree on one of four blocks of 16
bits, so every distinct fingerprint is sent, as 24 bytes, to its four buckets
``(mask, value of the masked bits)``. A bucket above ``bucket_rows`` is dealt anew on a
quarter of its remaining bits, twice if need be; what is still above that (thousands of
texts a few bits from each other) is cut into parts, each pair of which is a bucket of
its own. So no task holds more than ``bucket_rows`` fingerprints of one bucket, and no
candidate is dropped at any size.

Inside a bucket the fingerprints lie in Gray order, where neighbours share long runs of
bits. Consecutive ones form leaves, leaves form upper nodes; a node keeps the bits all
its members share (mask and value). Pairs of nodes descend together: the differences
in the shared bits of both are added up level by level, and a pair of groups is dropped
once the sum exceeds the distance. Groups already known to be one component are dropped
too. Each bucket yields a forest, at most one link per fingerprint, never all pairs.

The index takes fingerprints of one word or of several (``wide_fingerprint``), and can tell
the pairs through which it linked; ``near_copies`` uses both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import same_row, with_row_key, written
from claimgauge.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
BUCKET_ROWS = 20_000
LEVELS = 3
LEAF = 32
FANOUT = 8
#: 64-bit words of a wide fingerprint.
WORDS = 4

_KEYS = np.random.default_rng(SEED).integers(0, 1 << 63, WORDS, np.uint64)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# ---- fingerprints -----------------------------------------------------------------

def shingles_of(text: str | None, width: int = SHINGLE) -> list[bytes]:
    """Shingles of a lower-cased text, repeats included; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [joined]
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(space[:len(words) - width] + 1).tolist()]
    ends = [*space[width - 1:].tolist(), len(joined)]
    return [joined[s:e] for s, e in zip(starts, ends)]


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the shingle hashes as an unsigned integer; 0 without words."""
    shingles = shingles_of(text, width)
    if not shingles:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The majority bits of a set of 64-bit hashes, each mixed anew for each of ``WORDS`` words."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 1 << 12):
        mixed = hashes[at:at + (1 << 12), None] ^ _KEYS
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        part = mixed.astype("<u8").view(np.uint8).reshape(-1, 8 * WORDS)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


@F.pandas_udf(T.LongType())
def _fingerprint_udf(texts: pd.Series) -> pd.Series:
    known: dict[str | None, int] = {}
    for text in texts:
        if text not in known:
            known[text] = fingerprint(text)
    return pd.Series(np.array([known[t] for t in texts], np.uint64).view(np.int64))


def fingerprint_hex(fingerprint_column: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_column), 16, "0"))


# ---- the index inside one bucket --------------------------------------------------

def gray_ranks(fps: np.ndarray) -> list[np.ndarray]:
    """Places of wide fingerprints (words by fingerprints) in the Gray code, one sort key per word: the
    parity of a word goes on into the next one."""
    ranks, odd = [], np.uint64(0)
    for word in fps:
        rank = reduce(lambda g, k: g ^ (g >> np.uint64(k)), (1, 2, 4, 8, 16, 32), word)
        ranks.append(np.where(odd, ~rank, rank))
        odd = ranks[-1] & np.uint64(1)
    return ranks


def _bits(words: np.ndarray) -> np.ndarray:
    """Set bits over the words, which are the first axis."""
    counts = np.bitwise_count(words[0])
    if len(words) > 1:
        counts = counts.astype(np.uint16)
        for word in words[1:]:
            counts += np.bitwise_count(word)
    return counts


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray, links: list | None = None) -> np.ndarray:
    """Labels (least index of the component) after linking ``a`` to ``b``; one pair for each two
    components that meet is added to ``links``."""
    if links is not None and len(a):
        one, two = labels[a], labels[b]
        meeting = np.minimum(one, two) * len(labels) + np.maximum(one, two)
        met = np.flatnonzero(one != two)
        first = met[np.unique(meeting[met], return_index=True)[1]]
        links.append((a[first], b[first]))
    while True:
        one, two = labels[a], labels[b]
        apart = one != two
        if not apart.any():
            return labels
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))
        while True:
            short = labels[labels]
            if (short == labels).all():
                break
            labels = short


def _nodes(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Levels from the leaves up: (shared mask, shared value, fingerprints per node)."""
    levels, step = [], LEAF
    every = low = fps
    cuts = np.arange(0, fps.shape[1], LEAF)
    while True:
        every = np.bitwise_or.reduceat(every, cuts, axis=1)
        low = np.bitwise_and.reduceat(low, cuts, axis=1)
        mask = ~(every ^ low)
        levels.append((mask, low & mask, step))
        if mask.shape[1] <= FANOUT:
            return levels
        cuts, step = np.arange(0, mask.shape[1], FANOUT), step * FANOUT


def _one_label(labels: np.ndarray, step: int) -> np.ndarray:
    """Per node of ``step`` members: its label if all members have one, else -1."""
    cuts = np.arange(0, len(labels), step)
    low, high = np.minimum.reduceat(labels, cuts), np.maximum.reduceat(labels, cuts)
    return np.where(low == high, low, -1)


def link_bucket(fps: np.ndarray, distance: int = DISTANCE, links: list | None = None) -> np.ndarray:
    """Component labels of the fingerprints of a bucket, given in Gray order.

    ``fps`` has one axis, or words by fingerprints. Pairs of indexes (two arrays), each within
    ``distance``, that connect the components are added to ``links``.
    """
    fps = np.atleast_2d(fps)
    n = fps.shape[1]
    labels = np.arange(n)
    for k in range(1, min(LEAF, n)):
        near = np.flatnonzero(_bits(fps[:, k:] ^ fps[:, :-k]) <= distance)
        labels = _merge(labels, near, near + k, links)
    if n <= LEAF:
        return labels
    levels = _nodes(fps)
    top = len(levels) - 1
    a, b = np.triu_indices(levels[top][0].shape[1])
    stack = [(top, a, b, np.zeros(len(a), np.int64), np.zeros((len(fps), len(a)), np.uint64))]
    while stack:
        level, a, b, differ, counted = stack.pop()
        mask, value, step = levels[level]
        shared = mask[:, a] & mask[:, b]
        differ = differ + _bits((value[:, a] ^ value[:, b]) & shared & ~counted)
        one = _one_label(labels, step)
        keep = (differ <= distance) & ((one[a] < 0) | (one[a] != one[b]))
        a, b, differ, shared = a[keep], b[keep], differ[keep], shared[:, keep]
        if not len(a):
            continue
        if level == 0:
            labels = _link_leaves(fps, labels, a, b, distance, links)
            continue
        below = levels[level - 1][0].shape[1]
        i, j = np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij")
        ca = (a[:, None] * FANOUT + i.ravel()).ravel()
        cb = (b[:, None] * FANOUT + j.ravel()).ravel()
        real = (ca < below) & (cb < below) & (ca <= cb)
        ca, cb = ca[real], cb[real]
        differ = np.repeat(differ, FANOUT * FANOUT)[real]
        shared = np.repeat(shared, FANOUT * FANOUT, axis=1)[:, real]
        for at in range(0, len(ca), 1 << 15):
            cut = slice(at, at + (1 << 15))
            stack.append((level - 1, ca[cut], cb[cut], differ[cut], shared[:, cut]))
    return labels


def _link_leaves(fps, labels, a, b, distance, links) -> np.ndarray:
    n, within, half = fps.shape[1], np.arange(LEAF), (len(fps) + 1) // 2
    for at in range(0, len(a), 256):
        left = a[at:at + 256, None] * LEAF + within
        right = b[at:at + 256, None] * LEAF + within
        one, two = fps[:, np.minimum(left, n - 1)], fps[:, np.minimum(right, n - 1)]
        # Pairs too far apart in the first words are not compared in the others.
        apart = _bits(one[:half, :, :, None] ^ two[:half, :, None, :])
        pair, i, j = np.nonzero(apart <= distance)
        if half < len(fps):
            apart = apart[pair, i, j] + _bits(one[half:, pair, i] ^ two[half:, pair, j])
            pair, i, j = (x[apart <= distance] for x in (pair, i, j))
        i, j = left[pair, i], right[pair, j]
        real = (i < n) & (j < n) & (i != j)
        labels = _merge(labels, i[real], j[real], links)
    return labels


def _link_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forest links of the buckets of a sorted partition; a bucket may span batches."""
    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        fps = frame["fp"].to_numpy().view(np.uint64)
        starts = np.flatnonzero(new_bucket(frame))
        ends = np.append(starts[1:], len(frame))
        links = []
        for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            labels = link_bucket(fps[s:e])
            moved = np.flatnonzero(labels != np.arange(e - s))
            if len(moved):
                links.append((fps[s + moved], fps[s + labels[moved]]))
        a, b = (np.concatenate([x[k] for x in links]) if links else np.empty(0, np.uint64)
                for k in (0, 1))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def new_bucket(frame: pd.DataFrame) -> np.ndarray:
        keys = frame[["mask", "value", "part"]].to_numpy()
        return np.append([True], (keys[1:] != keys[:-1]).any(axis=1)) if len(keys) else keys[:, 0]

    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if len(frame):
            last = np.flatnonzero(new_bucket(frame))[-1]
            yield forest(frame.iloc[:last])
            rest = frame.iloc[last:]
    if rest is not None:
        yield forest(rest)


# ---- dealing fingerprints into buckets --------------------------------------------

def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def finer_masks(mask: int, blocks: int) -> list[int]:
    """``mask`` with one of ``blocks`` runs of its unset bits set: two fingerprints equal
    under ``mask`` and fewer than ``blocks`` bits apart are equal under one of these."""
    free = [i for i in range(64) if not mask >> i & 1]
    size, extra = divmod(len(free), blocks)
    masks, at = [], 0
    for k in range(blocks):
        run = free[at:at + size + (k < extra)]
        at += len(run)
        masks.append(mask | sum(1 << i for i in run))
    return masks


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray code: prefix parities of its bits."""
    return reduce(lambda g, k: g.bitwiseXOR(F.shiftrightunsigned(g, k)), (1, 2, 4, 8, 16, 32), fp)


def _deal(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Each row once per finer mask of its mask (0: not dealt yet)."""
    finer = {m: finer_masks(m, DISTANCE + 1) for m in masks}
    pairs = [F.lit(_signed(m)) if side == 0 else F.array(*[F.lit(_signed(x)) for x in finer[m]])
             for m in masks for side in (0, 1)]
    choice = F.element_at(F.create_map(*pairs), F.col("mask"))
    dealt = rows.select("fp", F.explode(choice).alias("mask"))
    return dealt.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def fingerprint_links(fps: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the distinct longs ``fp``: every two of them at most
    ``DISTANCE`` bits apart are connected by the links, if not by one link."""
    buckets, masks = [], [0]
    rows = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    for level in range(LEVELS):
        rows = _deal(rows, masks)
        masks = [x for m in masks for x in finer_masks(m, DISTANCE + 1)]
        sizes = rows.groupBy("mask", "value").count().where(F.col("count") > bucket_rows)
        hot = written(sizes, "hot-buckets")
        if hot.isEmpty():
            buckets.append(rows.withColumn("part", F.lit(0).cast("long")))
            break
        buckets.append(rows.join(hot, ["mask", "value"], "left_anti")
                       .withColumn("part", F.lit(0).cast("long")))
        rows = rows.join(hot, ["mask", "value"])
        if level == LEVELS - 1:
            buckets.append(_part_pairs(rows, bucket_rows))
        else:
            rows = rows.select("fp", "mask")
    dealt = reduce(DataFrame.unionByName, [b.select("fp", "mask", "value", "part") for b in buckets])
    return (dealt.repartition("mask", "value", "part")
            .withColumn("gray", gray_rank(F.col("fp")))
            .sortWithinPartitions("mask", "value", "part", "gray")
            .mapInPandas(_link_partition, "a long, b long"))


def _part_pairs(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Buckets above the bound, cut into parts; a row goes to each pair its part is in."""
    parts = F.ceil(F.lit(3) * F.col("count") / F.lit(bucket_rows))
    own = F.pmod(F.xxhash64("fp"), parts)
    other = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    return (rows.select("fp", "mask", "value", parts.alias("n"), own.alias("i"), other.alias("j"))
            .withColumn("part", F.least("i", "j") * F.col("n") + F.greatest("i", "j") + 1))


# ---- the operator -----------------------------------------------------------------

def near_duplicates(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: ``ROW_KEY``, ``fp`` (long), ``component_id``, ``keep``.

    ``component_id`` is the least ``doc_id`` of the component, null only if none of its
    documents has an id. ``keep`` marks one row key of each component: least id (a null id
    last), then least text hash. Null and blank texts have fingerprint 0 and are linked
    like any other; repeated rows come out as often as they came in. Extra columns of
    ``docs`` play no part. An empty table gives an empty one.
    """
    keyed = written(with_row_key(docs).select(
        "__id", "__text_hash", _fingerprint_udf("text").alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__text_hash"))
    fps = written(keyed.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(fingerprint_links(fps.select("fp"), bucket_rows))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy(F.col("root").alias("head")).agg(F.min("first").alias("chosen"))
    of_fp = rooted.join(heads, rooted["root"] == heads["head"]).select(
        F.col("fp").alias("of"), "chosen")
    met = keyed.join(of_fp, keyed["fp"] == of_fp["of"], "left")
    return met.select(
        *[keyed[c] for c in keyed.columns], F.col("chosen.__id").alias("component_id"),
        (F.col("__id").eqNullSafe(F.col("chosen.__id"))
         & (F.col("__text_hash") == F.col("chosen.__text_hash"))).alias("keep"))


def drop_near_duplicates(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one document of each component; repeated rows of the one that stays
    are dropped as well. Columns are those of ``docs``."""
    kept = (near_duplicates(docs, bucket_rows).where("keep")
            .select("__id", "__text_hash").distinct())
    keyed = with_row_key(docs)
    return (keyed.join(kept, same_row(keyed, kept), "left_semi")
            .dropDuplicates(["__id", "__text_hash"]).select(*docs.columns))
