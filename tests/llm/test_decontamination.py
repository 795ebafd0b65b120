import re

from pyspark.sql import functions as F

from claimgauge.llm import decontamination as d
from claimgauge.llm.queries import op4_template_decontamination
from tests.llm.helpers import awkward, clashing, documents, rows

SMALL = "/root/testdata/sf0.01"
QUESTION = ("A farmer has 12 sheep and buys 30 more. Each month, as planned, Tom sells 12 of the old sheep "
            "for 5 dollars. How many does the farmer keep after all that?")


def pairs(spark, texts, questions=(QUESTION,)):
    docs = documents(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(list(enumerate(questions)), "item_id long, text string")
    return {(r["__id"], r["item_id"]): r for r in d.contaminated_pairs(docs, bench).collect()}


def test_templates_keep_step_with_the_words(spark):
    text = "He paid $1,250.50 for 3 kg -- then Mary Smith left, 40% off. THE END!! of 7 days?"
    frame = documents(spark, [(1, text)])
    raw, form = frame.select(d.raw_tokens(frame.text), d.template_tokens(frame.text)).first()
    assert len(raw) == len(form)
    slots = [(f, r) for f, r in zip(form, raw) if f in (d.NUMBER, d.NAME, d.UNIT)]
    assert slots == [(d.NUMBER, "125050"), (d.NUMBER, "3"), (d.UNIT, "kg"), (d.NAME, "Mary"),
                     (d.NUMBER, "40"), (d.NUMBER, "7"), (d.UNIT, "days")] or (d.NAME, "Smith") in slots


def test_changed_parameters_are_caught_if_consistent(spark):
    changed = QUESTION.replace("12", "17").replace("Tom", "Jane").replace("dollars", "euros")
    torn = QUESTION.replace("12", "17", 1)
    found = pairs(spark, ["before it. " + QUESTION, "so. " + changed + " end", torn,
                          "A farmer has 12 sheep and buys nothing at all, as everyone knows."])
    assert set(found) == {(0, 0), (1, 0)}
    assert found[0, 0]["changed"] == 0 and found[0, 0]["matched"] == found[0, 0]["windows"]
    assert found[1, 0]["changed"] == 4 and found[1, 0]["slots"] == found[0, 0]["slots"]


def test_torn_variant_does_not_hide_the_item_behind_it(spark):
    torn = QUESTION.replace("12", "17", 1)
    changed = QUESTION.replace("12", "17").replace("Tom", "Jane")
    cut = changed.rsplit(" How", 1)[0]                            # fewer windows than the torn one
    split = QUESTION.replace("Each", "or so. Each")               # no offset has all windows
    texts = [f"{torn} {QUESTION}", f"{torn} then {changed}", f"{torn} {torn} {cut}", f"{torn} {torn}", split]
    found = pairs(spark, texts)
    assert set(found) == {(0, 0), (1, 0), (2, 0), (4, 0)}
    assert [found[i, 0]["offset"] for i in (0, 1, 2)] == [
        len(t.split()) for t in (torn, torn + " then", torn + torn + " x")]
    assert found[0, 0]["changed"] == 0 and found[1, 0]["changed"] == 3


def test_case_marks_and_place_do_not_hide_an_item(spark):
    loud = " ".join(w.upper() + "!!" for w in QUESTION.replace("Tom", "he").split())
    found = pairs(spark, [loud, "x " * 3000 + QUESTION + " y" * 3000],
                  [QUESTION.replace("Tom", "he"), QUESTION])
    assert {(0, 0), (1, 1)} <= set(found)


def test_tables_of_numbers_meet_no_item_by_form(spark):
    """Only the values of windows of numbers are joined: a long table meets an item of numbers
    where the values are the same, and a question around numbers by its words (18 windows, 5 of them
    numbers only)."""
    sort = "Please sort in ascending order the numbers 5 3 9 1 7 4 2 8 6 and print each of them once"
    table = " ".join(str(1000 + i) for i in range(3_000))
    texts = [table, f"{table} 12 30 45 60 75 90 {table}", sort.replace("5 3 9 1 7 4 2 8 6", "11 12 13 14 15 16 17 18 19"),
             "12 30 45 61 75 90", sort]
    questions = ["12 30 45 60 75 90", sort]
    found = pairs(spark, texts, questions)
    assert set(found) == {(1, 0), (2, 1), (4, 1)}
    assert found[1, 0]["windows"] == found[1, 0]["matched"] == 2 and found[1, 0]["offset"] == 3_000
    assert found[4, 1]["windows"] == found[4, 1]["matched"] == 13 and found[4, 1]["changed"] == 0
    tokens = documents(spark, [(0, table)]).select(
        d.template_tokens(F.col("text")).alias("tokens"), d.raw_tokens(F.col("text")).alias("raw"))
    assert tokens.select(F.explode(d.windows_of(F.col("tokens"), F.col("raw"))["hash"])).distinct().count() == 2_996


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "hash", "tokens", "offset", "item_id")
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, None), (None, "word5x word6x word7x "
                                   "word8x word9x word10x"), (4, ""), (5, "too short"),
                                   (1, "one two three four five six")], "item_id long, text string")
    found = d.contaminated_pairs(docs, bench)
    assert rows(found, "__id", "item_id", "matched") == [(1, 1, 2), (2, 1, 2), (6, None, 2)]
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    assert d.contaminated_pairs(docs.limit(0), bench).count() == 0
    assert d.contaminated_pairs(docs, bench.limit(0)).count() == 0


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch):
    want = pairs(spark, [QUESTION, "nothing of it"])
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 0)
    assert pairs(spark, [QUESTION, "nothing of it"]) == want


def test_query_equals_brute_force(spark):
    """The texts have no numbers or names inside items, so plain word windows must agree."""
    def words(text):
        return re.sub(r"[!-/:-@\[-`{-~]", "", text or "").lower().split()

    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = set()
    for i, item in items.items():
        places = [tuple(item[k:k + 5]) for k in range(len(item) - 4)]
        for n, doc in docs.items():
            seen = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
            if sum(p in seen for p in places) >= 0.6 * len(places):
                want.add((n, i))
    found = {tuple(r) for r in rows(op4_template_decontamination(spark, SMALL), "doc_id", "item_id")}
    assert want and found == want
