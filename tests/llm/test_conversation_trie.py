import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from claimgauge.llm.conversation_trie import conversation_trie, gathered, rebuilt, trie_nodes
from claimgauge.llm.queries import ORACLES, op12_conversation_trie
from tests.llm.helpers import clashing

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def turns_of(rows):
    """Turns of each conversation in order, nulls empty, ties by role and digest."""
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]

    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own[conv_id].append(((turn is not None, turn or 0), role, digest(role, text), text))
    return {c: [(t[1], t[3]) for t in sorted(turns)] for c, turns in own.items()}


def lent(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(sequences):
    """All nodes by listing the beginnings of every sequence."""
    members, under = defaultdict(list), defaultdict(set)
    for c, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                under[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(node[-1][1].encode().split()) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in under[node])
        leaves[node] = sum(leaves[x] for x in under[node]) or 1
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if tuple(sequences[c]) == node)
        rows.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids),
                     len(under[node]), leaves[node], saved[node],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def drawn(seed, convs, letters="ab", longest=7):
    dice = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(dice.randint(1, longest)):
            rows.append((c * dice.choice([1, 1, 3]) if turn == 0 else c, turn,
                         dice.choice(["user", "assistant"]) if turn > 3 else "user",
                         " ".join(dice.choice(letters) for _ in range(dice.randint(0, 2)))))
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,fan,parts", [(1, 3, 2, 5), (2, 1, 2, 7), (3, 5, 3, 4), (4, 4096, 64, 3)])
def test_blocks_and_boundaries(spark, seed, block, fan, parts):
    rows = drawn(seed, 60)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert got(conversation_trie(docs, block=block, fan=fan)) == plain(turns_of(rows))


def test_copies_a_third_and_beginnings_of_one_another(spark):
    rows = []
    for c in range(90):
        length = 40 if c % 3 == 0 else c % 30
        rows += [(c, t, "user", f"said {t}") for t in range(length)]
        rows += [(c, length, "user", f"own {c}")] * (c % 5 == 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(conversation_trie(docs, block=7, fan=2)) == plain(turns_of(rows))


def test_awkward_rows(spark):
    long = "word " * 50_000
    rows = [(None, 0, "user", "of nobody"), (1, None, "user", "first"), (1, 0, None, "second"),
            (1, 1, "user", None), (2, None, "user", "first"), (2, 0, "", "second"), (3, 0, None, None),
            (4, 0, "", ""), (-20, 0, "user", long), (-20, 1, "user", long), (7, 5, "user", "x"),
            (7, 5, "user", "x"), (7, 5, "user", "x"), (8, 5, "user", "x"), (9, 2, "us", "er"), (10, 2, "use", "r"),
            (2**62, 0, "user", "first")]
    docs = clashing(spark.createDataFrame(rows, SCHEMA), "said", "turns", "key", "h", "depth")
    assert got(conversation_trie(docs)) == plain(turns_of(rows))
    assert got(trie_nodes(rebuilt(gathered(docs)))) == plain(lent(turns_of(rows)))


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only turn") for c in range(21, 60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = plain(lent(turns_of(rows)))
    assert got(trie_nodes(rebuilt(gathered(docs)), block=4, fan=2)) == want
    root = next(r for r in want if r[1] == 0)
    assert root[7] != hashlib.sha256(b"").hexdigest()


def test_ids_of_one_key_in_many_blocks_are_hashed_in_order(spark):
    rows = [(c, 0, "user", "same") for c in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(conversation_trie(docs, block=16, fan=4)) == plain(turns_of(rows))


def test_query_against_its_sql_and_brute_force(spark):
    found = op12_conversation_trie(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    want = con.execute(ORACLES["op12_conversation_trie"])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(found.columns)
    assert set(dict(found.dtypes).values()) == {"bigint", "string"}
    answer = sorted((tuple(r) for r in found.select(*names).collect()), key=repr)
    assert sorted(want.fetchall(), key=repr) == answer
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(found) == plain(lent(turns_of(rows)))
