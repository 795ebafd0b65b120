"""Near copies by word shingles: five words, Jaccard similarity of 0.8 or more.

The method is SimHash with the Gray-order hierarchical index of ``simhash``, with parameters of
its own: edited copies are some 10 of 64 bits apart at a similarity of 0.8, so a text's
set of shingles gets a fingerprint of 256 bits, where such copies are about 38 bits apart
and unrelated texts 128. Fingerprints that agree in one of ``BLOCKS`` blocks of 12 bits share a
bucket, and the index links those within ``RADIUS`` bits. Each link is checked on the
whole sets; 95 % of the pairs at 0.8 agree in a block, 99 % at 0.85.

The index yields forests, and a link of a forest may fail the check where another would have
passed. So the trees that are still apart after the check are compared like the buckets of the second
way, which follows for what the index does not bring together: a set has ``BANDS`` MinHash bands of
``BAND_ROWS`` minima, and texts that agree in a band share a bucket, at a
similarity of s with probability 1 - (1 - s^5)^16 (99.8 % at 0.8). All pairs of such a bucket
that the links so far leave apart are compared on their whole sets. A pair is missed
only if both ways miss it.

How the work is dealt. Equal sets are one node. A bucket of the index above ``simhash.BUCKET_ROWS``
is cut into parts, each pair of which is a bucket. In the second way,
a bucket's first member is compared with all others of it, ``STARS`` times over with another
first member; that is linear in the bucket, and joins whose hot side, the first member, is
salted. A bucket gets its first member and size by cells (``with_facts``), so a hot one is no
hot task. Only buckets that still have several components are compared pair by pair in
one task each, cut into parts above ``PART_ROWS``; there, members of one component are
not compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.common import same_row, with_row_key, written
from claimgauge.llm.components import components
from claimgauge.llm.simhash import BUCKET_ROWS, SEED, WORDS, gray_ranks, link_bucket, shingles_of, wide_fingerprint

SHINGLE = 5
SIMILARITY = 0.8
#: Blocks of a fingerprint and of one of its words; bits between linked fingerprints, three
#: standard deviations above the mean of pairs at ``SIMILARITY``.
WORD_BLOCKS, BLOCK_BITS = 5, 12
BLOCKS = WORD_BLOCKS * WORDS
RADIUS = 56
BANDS, BAND_ROWS = 16, 5
STARS = 2
#: Rows that share one copy of a first member's set.
SALT_ROWS = 500
PART_ROWS = 1_000
#: Parts of a group that is joined with its own totals; bits of a long.
CELLS = 64

_DICE = np.random.default_rng(SEED)
_FACTORS = _DICE.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _DICE.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; empty without words."""
    shingles = shingles_of(text, SHINGLE)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles)))


def bands_of(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit bucket per band; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), ~np.uint64(0))
    for at in range(0, len(hashes), 1 << 10):
        mixed = hashes[at:at + (1 << 10), None] * _FACTORS + _ADDENDS
        least = np.minimum(least, mixed.min(axis=0))
    buckets = [xxhash.xxh64_intdigest(band.tobytes(), k)
               for k, band in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(buckets, np.uint64).view(np.int64).tolist()


@F.pandas_udf(T.StructType().add("node", T.LongType()).add("bands", T.ArrayType(T.LongType()))
              .add("print", T.ArrayType(T.LongType())))
def _sketch(texts: pd.Series) -> pd.DataFrame:
    known: dict[str | None, tuple] = {}
    for text in texts:
        if text not in known:
            hashes = shingle_set(text)
            node = np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64)
            known[text] = int(node), bands_of(hashes), wide_fingerprint(hashes).view(np.int64).tolist()
    return pd.DataFrame([known[t] for t in texts], columns=["node", "bands", "print"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingle_set(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).view(np.int64) for t in texts])


def with_facts(rows: DataFrame, key: str, by: str, *facts: Column, where: str = "true") -> DataFrame:
    """``rows`` of the groups of ``key`` that satisfy ``where``, plus aggregates of their group.

    A group may be hot: its aggregates are combined before they are shuffled, and joined back on
    the key and one of ``CELLS`` cells, the hash of column ``by``. A group's aggregates are repeated
    only for the cells it has rows in.
    """
    cells = rows.withColumn("cell", F.pmod(F.xxhash64(by), F.lit(CELLS)).cast("int"))
    groups = cells.groupBy(key).agg(F.expr("bit_or(shiftleft(1L, cell))").alias("present"), *facts)
    present = F.filter(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: F.getbit("present", i) == 1)
    return cells.join(groups.where(where).withColumn("cell", F.explode(present)).drop("present"),
                      [key, "cell"]).drop("cell")


def alike(common: Column, one: Column, two: Column) -> Column:
    return common >= F.lit(SIMILARITY) * (one + two - common)


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct ``(a, b)`` of ``pairs`` whose sets are alike; ``a`` may be very frequent."""
    pairs = written(pairs.distinct(), "pairs")
    counted = F.ceil(F.count("*") / SALT_ROWS).alias("salts")
    salts = pairs.groupBy("a").agg(counted)
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    first = sets.join(salts, sets["node"] == salts["a"]).select(
        F.col("node").alias("of"), "salts", salt.alias("salt"), F.col("hashes").alias("one"))
    salted = with_facts(pairs, "a", "b", counted).select("a", "b", F.pmod(F.xxhash64("b"), "salts").alias("salt"))
    met = salted.join(sets, salted["b"] == sets["node"]).select(
        "a", "b", "salt", F.col("hashes").alias("two"))
    met = met.join(first, (met["a"] == first["of"]) & (met["salt"] == first["salt"]))
    sizes = F.size("one"), F.size("two")
    # Sets of too different sizes cannot be alike; the others are intersected.
    return met.where(F.least(*sizes) >= F.lit(SIMILARITY) * F.greatest(*sizes)).where(
        alike(F.size(F.array_intersect("one", "two")), *sizes)).select("a", "b")


def link_sets(sets: list[np.ndarray], labels: np.ndarray) -> list[tuple[int, int]]:
    """Links (i, j) that connect all alike sets that differ in label."""
    labels, links = labels.copy(), []
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    ends = np.cumsum(sizes)
    for i in range(len(sets) - 1):
        others = i + 1 + np.flatnonzero(labels[i + 1:] != labels[i])
        if not len(others):
            continue
        mine = np.zeros(flat.max() + 1, bool)
        mine[flat[ends[i] - sizes[i]:ends[i]]] = True
        after = slice(ends[i], None)
        common = np.bincount(owner[after][mine[flat[after]]], minlength=len(sets))[others]
        for j in others[common >= SIMILARITY * (sizes[i] + sizes[others] - common)]:
            if labels[j] != labels[i]:
                links.append((i, int(j)))
                labels[labels == labels[j]] = labels[i]
    return links


def _by_bucket(frames: Iterator[pd.DataFrame],
               forest: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``forest`` of the frames of a sorted partition, cut so that no bucket spans two."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if len(frame):
            last = (frame[["bucket", "part"]] == frame[["bucket", "part"]].iloc[-1]).all(axis=1)
            yield forest(frame[~last])
            rest = frame[last]
    if rest is not None:
        yield forest(rest)


def _link_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the buckets of a sorted partition."""
    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, bucket in frame.groupby(["bucket", "part"], sort=False):
            nodes, labels = bucket["node"].to_numpy(), bucket["label"].to_numpy()
            if (labels != labels[0]).any():
                links += [(nodes[i], nodes[j]) for i, j in link_sets(list(bucket["hashes"]), labels)]
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return _by_bucket(frames, forest)


def _near_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs within ``RADIUS`` bits that connect the fingerprints of a bucket, by its Gray-order index."""
    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        words = frame[[f"word{i}" for i in range(WORDS)]].to_numpy().view(np.uint64).T
        order = np.lexsort([*gray_ranks(words)[::-1], frame["part"], frame["bucket"]])
        words, nodes = np.ascontiguousarray(words[:, order]), frame["node"].to_numpy()[order]
        keys = frame[["bucket", "part"]].to_numpy()[order]
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        links = [(np.empty(0, np.int64),) * 2]
        for s, e in zip([0, *changes], [*changes, len(keys)]):
            if e - s > 1:
                near: list[tuple] = []
                link_bucket(words[:, s:e], RADIUS, near)
                links += [(nodes[s + i], nodes[s + j]) for i, j in near]
        a, b = (np.concatenate(side) for side in zip(*links))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return _by_bucket(frames, forest)


def close_pairs(prints: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs ``(a, b)`` of ``node`` that connect the fingerprints ``print`` (arrays of ``WORDS`` longs)
    that agree in a block and are within ``RADIUS`` bits; ``a`` is the lesser one. A pair may come
    once per block. A bucket above ``bucket_rows`` is cut into parts, each pair of which is a bucket
    of its own, so no pair is lost and no task holds more."""
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    words = [F.element_at("print", i + 1).alias(f"word{i}") for i in range(WORDS)]
    word = F.element_at("print", F.floor(F.col("block") / WORD_BLOCKS).cast("int") + 1)
    places = [F.shiftrightunsigned(word, BLOCK_BITS * k).bitwiseAND((1 << BLOCK_BITS) - 1) for k in range(WORD_BLOCKS)]
    value = F.element_at(F.array(*places), (F.col("block") % WORD_BLOCKS + 1).cast("int"))
    dealt = prints.withColumn("block", block).select(
        (F.col("block") * (1 << BLOCK_BITS) + value).cast("long").alias("bucket"), "node", *words)
    # At most one row per bucket, of which there are BLOCKS * 4096.
    hot = F.broadcast(dealt.groupBy("bucket").count().where(F.col("count") > bucket_rows))
    parts = F.coalesce(F.ceil(F.lit(2) * F.col("count") / bucket_rows), F.lit(1)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    cut = (dealt.join(hot, "bucket", "left").withColumn("parts", parts)
           .withColumn("i", F.pmod(F.xxhash64("node", "bucket"), "parts")).withColumn("j", other)
           .withColumn("part", F.least("i", "j") * F.col("parts") + F.greatest("i", "j"))
           .select("bucket", "part", "node", *[f"word{i}" for i in range(WORDS)]))
    return (cut.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
            .mapInPandas(_near_partition, "a long, b long"))


def _pairwise(members: DataFrame, sets: DataFrame, part_rows: int) -> DataFrame:
    """Links inside buckets of ``members`` (``bucket``, ``node``, ``label``, ``size``), each pair of
    which meets in one task."""
    parts = F.when(F.col("size") > part_rows, F.ceil(F.lit(2) * F.col("size") / part_rows)).otherwise(
        F.lit(1)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    cut = (members.withColumn("parts", parts)
           .select("bucket", "node", "label", "parts", F.pmod(F.xxhash64("node"), "parts").alias("i"),
                   other.alias("j"))
           .select("bucket", "node", "label",
                   (F.least("i", "j") * F.col("parts") + F.greatest("i", "j")).alias("part")))
    return (cut.join(sets, "node").repartition("bucket", "part").sortWithinPartitions("bucket", "part")
            .select("bucket", "part", "node", "label", "hashes")
            .mapInPandas(_link_partition, "a long, b long"))


def _several(members: DataFrame) -> DataFrame:
    """The members (``bucket``, ``node``, ``label``) of buckets with several labels, plus the least
    node of the bucket, its label and the bucket's size."""
    return with_facts(members, "bucket", "node", F.min("node").alias("head"),
                      F.min_by("label", "node").alias("head_label"), F.count("*").alias("size"),
                      F.min("label").alias("low"), F.max("label").alias("high"),
                      where="low < high").drop("low", "high")


def _relabelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members (``bucket``, ``node``) of buckets that ``links`` leave apart, as of ``_several``."""
    roots = components(links).withColumnRenamed("node", "of")
    rooted = written(members.join(roots, members["node"] == roots["of"], "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("label")), "members")
    return written(_several(rooted), "open-buckets")


def set_links(sets: DataFrame, members: DataFrame, known: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Links ``(a, b)`` that, with the links ``known``, connect all alike sets of a bucket of ``members``
    (``bucket``, ``node``); ``known`` ones are among them."""
    links, open_ = [known], _relabelled(members, known)
    for _ in range(STARS):
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, links)
        pairs = open_.where((F.col("node") != F.col("head")) & (F.col("label") != F.col("head_label")))
        links.append(written(_checked(pairs.select(F.col("head").alias("a"), F.col("node").alias("b")),
                                      sets), "links"))
        rest = open_.where(F.col("node") != F.col("head")).select("bucket", "node")
        open_ = _relabelled(rest, reduce(DataFrame.unionByName, links))
    if not open_.isEmpty():
        links.append(_pairwise(open_, sets, part_rows))
    return reduce(DataFrame.unionByName, links)


def tree_members(close: DataFrame) -> DataFrame:
    """The nodes of each tree of the pairs ``close`` as members (``bucket``, ``node``) of one bucket. All
    pairs within ``RADIUS`` bits lie in one tree, though the index may not have named them."""
    trees = components(close)
    roots = trees.select(F.col("root").alias("node"), "root").distinct()
    return trees.unionByName(roots).select(F.xxhash64(F.lit("tree"), "root").alias("bucket"), "node")


def near_copies(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per document: ``ROW_KEY``, ``node`` (long, its set of shingles), ``keep``.

    Texts that are alike, directly or by way of others, are one component. ``keep`` marks
    one row key of each: least id (a null id last), then least text hash. Texts without
    words are alike; a text of fewer than five words is one shingle. Repeated rows come
    out as often as they came in.
    """
    keyed = written(with_row_key(docs).select("__id", "__text_hash", _sketch("text").alias("sketch")).select(
        "__id", "__text_hash", "sketch.*"), "sketches")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__text_hash"))
    nodes = written(keyed.groupBy("node").agg(first.alias("first"), F.first("bands").alias("bands"),
                                              F.first("print").alias("print")), "distinct-sets")
    close = written(close_pairs(nodes.where(F.size("bands") > 0).select("node", "print")).distinct(), "close-pairs")
    spread = nodes.select("node", F.col("node").alias("label"), F.explode("bands").alias("bucket"))
    members = written(_several(spread).select("bucket", "node"), "buckets")
    asked = members.select("node").unionByName(close.select(F.col("a").alias("node"))).unionByName(
        close.select(F.col("b").alias("node"))).distinct()
    shared = nodes.join(asked, "node").select("node", "first.__id", "first.__text_hash")
    texts = with_row_key(docs.select("doc_id", "text"))
    sets = written(texts.join(shared, same_row(texts, shared)).select(
        "node", _shingle_set("text").alias("hashes")).dropDuplicates(["node"]), "shingle-sets")
    known = written(_checked(close, sets), "close-links")
    # where a link of a tree failed, another might pass: such trees are compared like buckets
    members = members.unionByName(tree_members(close))
    roots = components(set_links(sets, members, known, part_rows)).withColumnRenamed("node", "of")
    rooted = nodes.join(roots, nodes["node"] == roots["of"], "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.__id").alias("__id"), F.col("first.__text_hash").alias("__text_hash"),
        F.lit(True).alias("chosen"))
    return keyed.join(chosen, same_row(keyed, chosen), "left").select(
        keyed["__id"], keyed["__text_hash"], "node", F.coalesce("chosen", F.lit(False)).alias("keep"))


def drop_near_copies(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs`` with one document of each component; repeated rows of the one that stays
    are dropped as well. Columns are those of ``docs``."""
    kept = near_copies(docs, part_rows).where("keep").select("__id", "__text_hash").distinct()
    keyed = with_row_key(docs)
    return (keyed.join(kept, same_row(keyed, kept), "left_semi")
            .dropDuplicates(["__id", "__text_hash"]).select(*docs.columns))
