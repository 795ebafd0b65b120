"""The prefix trie of conversations by union-find over sorted neighbours.

A conversation becomes a key: 16 bytes of a SHA-256 for each turn, in order. Keys are range
partitioned and sorted; neighbours share so many turns (LCP). In a block of sorted keys
the edges between neighbours are taken by descending LCP and joined by union-find: each
merge of two components makes a branching node at the depth of the edge, under which the
components hang as children. Turns between a node and the one above it form a chain with
the same members, so only ends of conversations and branchings are nodes here.

Nodes that hold neither the first nor the last key of their block are complete. The others
lie on two paths to the top of the block; with the counts of their other children they are
the contracted forest of the block, which again is a row of items with LCP edges. Blocks
are merged ``FAN`` at a time, in rounds, by the same union-find, and the edges between
blocks come from their outermost keys. So a task holds one block of conversations, or ``FAN``
pairs of paths, however many there are in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import words_of, written

#: Bytes of a turn in a key.
TURN = 16
#: Conversations of one block, and blocks of one merge.
BLOCK, FAN = 4_096, 64
NO_ENDS = hashlib.sha256(b"").hexdigest()

_ITEM = pa.struct([("depth", pa.int64()), ("n", pa.int64()), ("least", pa.int64()),
                   ("children", pa.int64()), ("leaves", pa.int64()), ("below", pa.int64()),
                   ("end", pa.binary())])
#: Rows of one round. ``chain``: a complete node with the turns above it; ``block``: a contracted
#: forest; ``alias``: what became of an item of the round before; ``ends``: ids of one key.
_ROUND = pa.schema([
    ("kind", pa.string()), ("part", pa.int64()), ("seq", pa.int64()),
    ("owner", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("below", pa.int64()),
    ("rest", pa.list_(pa.int64())), ("end", pa.binary()), ("parent", pa.int64()), ("ref", pa.string()),
    ("alias", pa.string()), ("ids", pa.string()), ("items", pa.list_(_ITEM)),
    ("first_key", pa.binary()), ("last_key", pa.binary()),
    ("first_words", pa.list_(pa.int64())), ("last_words", pa.list_(pa.int64()))])
_ROUND_DDL = (
    "kind string, part long, seq long, owner long, low long, high long, n long, children long, "
    "leaves long, below long, rest array<long>, end binary, parent long, ref string, alias string, "
    "ids string, items array<struct<depth long, n long, least long, children long, leaves long, "
    "below long, end binary>>, first_key binary, last_key binary, first_words array<long>, "
    "last_words array<long>")


@dataclass(eq=False, slots=True)
class _Node:
    depth: int
    n: int
    least: int
    children: int
    leaves: int
    below: int  #: saved tokens of all chains that hang under the node
    end: bytes | None
    words: list[int]  #: words up to each depth, of some member
    up: _Node | None = None
    same: _Node | None = None  #: set once the node was found to be another's

    def tips(self) -> int:
        return self.leaves if self.children else 1

    def saved(self, above: int) -> int:
        """Saved tokens of the node, its subtree and its chain from ``above`` on."""
        return self.below + (self.n - 1) * (self.words[self.depth] - self.words[above])

    def take(self, other: _Node) -> None:
        """``other`` becomes a child, or, at the same depth, a part of this node."""
        self.n += other.n
        self.least = min(self.least, other.least)
        if other.depth == self.depth:
            other.same = self
            self.children += other.children
            self.leaves += other.leaves
            self.below += other.below
            self.end = self.end or other.end
        else:
            other.up = self
            self.children += 1
            self.leaves += other.tips()
            self.below += other.saved(self.depth)


def _now(node: _Node) -> _Node:
    while node.same is not None:
        node = node.same
    return node


def _joined(items: list[_Node], edges: list[int]) -> list[_Node]:
    """All nodes of the items, and of the branchings that joining neighbours by descending
    LCP makes; ``edges[k]`` is the LCP of items k and k + 1."""
    nodes, root, top = list(items), list(range(len(items))), list(items)

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in sorted(range(len(edges)), key=edges.__getitem__, reverse=True):
        a, b, depth = find(k), find(k + 1), edges[k]
        both = sorted((top[a], top[b]), key=lambda node: node.depth)
        if both[0].depth > depth:
            both.insert(0, _Node(depth, 0, both[0].least, 0, 0, 0, None, both[0].words))
            nodes.append(both[0])
        for other in both[1:]:
            both[0].take(other)
        root[b], top[a] = a, both[0]
    return nodes


def _path(node: _Node) -> list[_Node]:
    """The node and all above it."""
    path = [_now(node)]
    while path[-1].up is not None:
        path.append(_now(path[-1].up))
    return path


def _chain(node: _Node, above: _Node | None, ref: str | None) -> dict:
    low, words = -1 if above is None else above.depth, node.words
    rest = [words[node.depth] - words[max(d - 1, 0)] for d in range(low + 1, node.depth + 1)]
    parent = None if above is None or ref else above.least
    return {"kind": "chain", "owner": node.least, "low": low, "high": node.depth, "n": node.n,
            "children": node.children, "leaves": node.tips(), "below": node.below, "rest": rest,
            "end": node.end, "parent": parent, "ref": ref}


def _settled(items: list[_Node], edges: list[int], names: list[str], prefix: str,
             final: bool) -> tuple[list[dict], list[dict]]:
    """Rows for the complete nodes and for what became of the items called ``names``, and
    the items of the contracted forest, called ``prefix`` and their number."""
    nodes = _joined(items, edges)
    left, right = _path(items[0]), _path(items[-1])
    kept, open_at = [], {}
    if final:
        if left[-1].depth:
            nodes.append(_Node(0, 0, left[-1].least, 0, 0, 0, None, [0]))
            nodes[-1].take(left[-1])
    else:
        kept = left + right[-2::-1]
        open_at = {id(node): f"{prefix}.{j}" for j, node in enumerate(kept)}
    rows = []
    for node in nodes:
        if node.same is None and id(node) not in open_at:
            above = None if node.up is None else _now(node.up)
            rows.append(_chain(node, above, open_at.get(id(above))))
    for name, item in zip(names, items):
        node = _now(item)
        ref = open_at.get(id(node))
        rows.append({"kind": "alias", "alias": name, "ref": ref, "parent": None if ref else node.least})
    # A kept item counts what is under it but for the child on the path, which is kept too.
    counts = {id(x): [x.n, x.children, x.leaves, x.below] for x in kept}
    for x in {id(x): x for x in kept if x.up is not None}.values():
        above = _now(x.up)
        own = counts[id(above)]
        for j, part in enumerate((x.n, 1, x.tips(), x.saved(above.depth))):
            own[j] -= part
    contracted = [dict(zip(("n", "children", "leaves", "below"), counts[id(x)]), depth=x.depth,
                       least=x.least, end=x.end) for x in kept]
    return rows, contracted


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two keys share from their beginnings."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * TURN:mid * TURN] == b[low * TURN:mid * TURN]:
            low = mid
        else:
            high = mid - 1
    return low


def _block(part: int, seq: int, entries: list[tuple]) -> list[dict]:
    """Rows of one block of sorted conversations ``(key, words of the turns, ids)``."""
    items, ends = [], []
    for key, words, ids in entries:
        end = hashlib.sha256(key).digest()
        items.append(_Node(len(key) // TURN, len(ids), ids[0], 0, 0, 0, end,
                           [0, *accumulate(words)]))
        ends.append({"kind": "ends", "part": part, "seq": seq, "end": end,
                     "ids": ",".join(map(str, ids))})
    first, last = items[0].words, items[-1].words
    edges = [_shared(a[0], b[0]) for a, b in zip(entries, entries[1:])]
    rows, contracted = _settled(items, edges, [], f"0.{part}.{seq}", final=False)
    return [*rows, *ends, {
        "kind": "block", "part": part, "seq": seq, "items": contracted, "first_key": entries[0][0],
        "last_key": entries[-1][0], "first_words": first, "last_words": last}]


def _blocks(frames: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    part, seq, entries, held = TaskContext.get().partitionId(), 0, [], 0
    for frame in frames:
        for conv_id, key, words in zip(*(frame.column(n).to_pylist() for n in ("id", "key", "words"))):
            if held == block:
                yield pa.RecordBatch.from_pylist(_block(part, seq, entries), _ROUND)
                seq, entries, held = seq + 1, [], 0
            if entries and entries[-1][0] == key:
                entries[-1][2].append(conv_id)
            else:
                entries.append((key, words, [conv_id]))
            held += 1
    if entries:
        yield pa.RecordBatch.from_pylist(_block(part, seq, entries), _ROUND)


def _merge(fan: int, level: int, final: bool):
    """What joins the blocks of one group."""
    return lambda table: _merged(table, fan, level, final)


def _merged(table: pa.Table, fan: int, level: int, final: bool) -> pa.Table:
    """One group of contracted blocks as one block of the next round."""
    blocks = table.sort_by("place").to_pylist()
    items, edges, names = [], [], []
    for k, block in enumerate(blocks):
        if k:
            edges.append(_shared(blocks[k - 1]["last_key"], block["first_key"]))
        depths = [item["depth"] for item in block["items"]]
        top = depths.index(min(depths))
        edges += [min(pair) for pair in zip(depths, depths[1:])]
        for j, item in enumerate(block["items"]):
            items.append(_Node(**item, words=block["first_words" if j <= top else "last_words"]))
            names.append(f"{level}.{block['name']}.{j}")
    place = blocks[0]["place"] // fan
    rows, contracted = _settled(items, edges, names, f"{level + 1}.{place}", final)
    if not final:
        rows.append({"kind": "block", "part": place, "seq": 0, "items": contracted,
                     "first_key": blocks[0]["first_key"], "last_key": blocks[-1]["last_key"],
                     "first_words": blocks[0]["first_words"], "last_words": blocks[-1]["last_words"]})
    return pa.Table.from_pylist(rows, _ROUND)


def _hashed_ends(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each key, whose pieces come in order."""
    schema = pa.schema([("end", pa.binary()), ("ends_sha256", pa.string())])
    key = digest = None
    for frame in frames:
        done = []
        for end, ids in zip(frame.column("end").to_pylist(), frame.column("ids").to_pylist()):
            if end == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append({"end": key, "ends_sha256": digest.hexdigest()})
            key, digest = end, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"end": key, "ends_sha256": digest.hexdigest()}], schema)


def gathered(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``: an array of ``digest`` (of role and text, 16 bytes) and
    ``words``, in order of ``turn`` (null first), then role, then digest. Texts are not shuffled."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct(
            "turn", role.alias("role"),
            F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 2 * TURN)).alias("digest"),
            F.size(words_of(text)).cast("long").alias("words")).alias("said"))
    return turns.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("said")), lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def rebuilt(sequences: DataFrame, every: int = 20, borrowed: Column | None = None) -> DataFrame:
    """Each conversation with its first turns taken from the one whose id is the next
    multiple of ``every`` below: so many as ``borrowed`` says, crc32 of the id modulo 4."""
    if borrowed is None:
        borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    sequences = written(sequences.withColumn("h", borrowed.cast("int")), "conversations")
    lenders = sequences.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("lender"), F.slice("turns", 1, 3).alias("head"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    met = sequences.join(lenders, F.col("conv_id") - F.col("conv_id") % every == F.col("lender"), "left")
    return met.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(
        F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def trie_nodes(sequences: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per distinct beginning of the sequences (``conv_id``, ``turns`` as in
    ``gathered``): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``conv_id`` must be unique and not null. A sequence without turns is a member of the root
    alone. Without sequences there is no root. The key of a conversation, 16 bytes a turn,
    lies in one row; texts do not.
    """
    keys = sequences.select(
        F.col("conv_id").alias("id"),
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"))
    found = [written(
        keys.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
        .mapInArrow(lambda frames: _blocks(frames, block), _ROUND_DDL), "trie")]
    spark = sequences.sparkSession
    while True:
        level = len(found) - 1
        blocks = found[-1].where(F.col("kind") == "block")
        # One row per partition, then per block of the round: counts that number the blocks.
        counts = sorted(tuple(r) for r in blocks.groupBy("part").count().collect())
        total = sum(n for _, n in counts)
        if not total:
            break
        starts = [(part, end - n) for (part, n), end in zip(counts, accumulate(n for _, n in counts))]
        placed = blocks.join(F.broadcast(spark.createDataFrame(starts, "part long, start long")), "part")
        name = (F.concat_ws(".", "part", "seq") if level == 0 else F.col("part").cast("string"))
        placed = placed.select(
            (F.col("start") + F.col("seq")).alias("place"), name.alias("name"), "items",
            "first_key", "last_key", "first_words", "last_words")
        final = total <= fan
        found.append(written(
            placed.withColumn("group", F.floor(F.col("place") / fan)).groupBy("group").applyInArrow(
                _merge(fan, level, final), _ROUND_DDL), "trie"))
        if final:
            break
    return _rows(found)


def _rows(found: list[DataFrame]) -> DataFrame:
    """Rows of the trie from all rounds: items and parents resolved, chains unfolded."""
    chains = found[0].where(F.col("kind") == "chain")
    known = None
    for result in reversed(found[1:]):
        chains = chains.unionByName(result.where(F.col("kind") == "chain"))
        alias = result.where(F.col("kind") == "alias").select("alias", "parent", "ref")
        here = alias.where(F.col("ref").isNull()).select("alias", "parent")
        if known is not None:
            here = here.unionByName(alias.where(F.col("ref").isNotNull()).select("alias", "ref").join(
                known.withColumnRenamed("alias", "ref"), "ref").select("alias", "parent"))
        known = here if known is None else known.unionByName(here)
    ends = (found[0].where(F.col("kind") == "ends").select("end", "part", "seq", "ids")
            .repartition("end").sortWithinPartitions("end", "part", "seq")
            .select("end", "ids").mapInArrow(_hashed_ends, "end binary, ends_sha256 string"))
    if known is not None:
        open_chains = chains.where(F.col("ref").isNotNull()).drop("parent").join(
            known.withColumnRenamed("alias", "ref"), "ref")
        chains = chains.where(F.col("ref").isNull()).unionByName(open_chains)
    here = F.col("depth") == F.col("high")
    return (chains.join(ends, "end", "left")
            .select("*", F.posexplode("rest").alias("at", "left"))
            .withColumn("depth", F.col("low") + 1 + F.col("at"))
            .select(F.col("owner").alias("conv_id"), "depth",
                    F.when(F.col("depth") == F.col("low") + 1, F.col("parent"))
                    .otherwise(F.col("owner")).alias("parent_conv_id"),
                    F.col("n").alias("n_convs"),
                    F.when(here, F.col("children")).otherwise(1).alias("n_children"),
                    F.col("leaves").alias("n_leaves"),
                    (F.col("below") + (F.col("n") - 1) * F.col("left")).alias("saved_tokens"),
                    F.coalesce(F.when(here, F.col("ends_sha256")), F.lit(NO_ENDS)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """``trie_nodes`` of a table of ``conv_id``, ``turn``, ``role``, ``text``.

    Null roles and texts count as empty; rows without ``conv_id`` belong to no conversation and
    are left out. Turns of equal number are ordered by role, then by digest; rows repeated
    in full are turns of their own. An empty table gives an empty one; other columns are
    not looked at.
    """
    return trie_nodes(gathered(conversations), block, fan)
