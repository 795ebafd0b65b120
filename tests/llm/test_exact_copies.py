import hashlib
import random

import duckdb
import pytest

from claimgauge.llm.exact_copies import drop_exact_copies, exact_groups
from claimgauge.llm.queries import ORACLES, op13_tree_merge_dedup
from tests.llm.helpers import awkward, clashing, documents

SMALL = "/root/testdata/sf0.001"


def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


def plain(rows):
    """(id, keep_id, size, sha) of every row and how many rows of a group stay, by dictionary."""
    groups = {}
    for i, text in rows:
        groups.setdefault(bare(text), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        group = groups[bare(text)]
        out.append((i, min(group)[3], len(group), hashlib.sha256(bare(text).encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


def check(docs, **parameters):
    found = exact_groups(docs, **parameters).collect()
    want, groups = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found),
                  key=repr) == want
    kept = [r for r in found if r["kept"]]
    assert len(kept) == groups
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_awkward_rows(spark):
    check(clashing(awkward(spark), "id", "digest", "sha", "row", "leaf", "size", "keep_id"))


def test_empty_table(spark):
    assert exact_groups(documents(spark, []).limit(0)).count() == 0
    assert drop_exact_copies(documents(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("steps,hot,parts", [(1, 1_000, 23), (2, 3, 40), (4, 10**9, 17)])
def test_levels_hot_groups_and_white_space(spark, steps, hot, parts):
    dice = random.Random(parts)
    rows = []
    for i in range(1_500):
        text = "same words here" if i % 3 == 0 else f"text number {dice.randint(0, 400)}"
        rows.append((i, text.replace(" ", dice.choice([" ", "  ", "\t", "\n", "\x0b", ""]))))
    dice.shuffle(rows)
    check(documents(spark, rows).repartition(parts), steps=steps, hot=hot)


def test_other_white_space_counts_and_ties_go_to_the_smallest_id(spark):
    docs = documents(spark, [(5, "a b"), (3, "a\tb"), (4, "ab"), (9, "a\xa0b"), (8, "a b"), (2, "ab")])
    found = {r["id"]: (r["keep_id"], r["group_size"]) for r in exact_groups(docs).collect()}
    assert found == {5: (3, 4), 3: (3, 4), 4: (3, 4), 2: (3, 4), 9: (9, 1), 8: (8, 1)}


def test_one_row_of_a_group_stays_with_its_columns(spark):
    docs = clashing(awkward(spark), "row", "kept")
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [bare(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({bare(r["text"]) for r in docs.collect()})


def test_query_against_its_sql(spark):
    found = op13_tree_merge_dedup(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(ORACLES["op13_tree_merge_dedup"])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(want.fetchall()) == sorted(tuple(r) for r in found.select(*names).collect())


def test_no_python_and_a_streaming_merge(spark):
    plan = exact_groups(documents(spark, [(1, "a"), (2, "a"), (3, "b")]))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
