"""Quality rules of documents, and verdicts on their hosts (DataFrame functions only).

Each document is counted in one pass over its text. Rule failures are then aggregated by
host, the failure rates are shrunk towards a beta prior fitted to all hosts (moments of
their rates), and hosts that still fail too often take their documents with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import WHITE, let, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
#: A host is rejected once the shrunk failure rate of any rule is above the prior's mean by
#: so many of its standard deviations, though not below the first bound, and above the
#: second in any case.
PRIOR_DEVIATIONS = 2.0
HOST_LIMITS = (0.2, 0.5)
#: Bounds of the prior's weight in documents.
PRIOR_WEIGHT = (1.0, 1000.0)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more, its first place included.

    Windows are told apart by XXH64. Only a text in which two are equal pays for sorting
    them with their places.
    """
    count = F.size(words)
    hashes = F.when(count >= window, F.transform(
        F.sequence(F.lit(1), F.greatest(count - (window - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(words, i, window)))).otherwise(
            F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(
            F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def twice(ordered: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(ordered, at)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(
            F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

    def places(found: Column) -> Column:
        return F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    return let(hashes, lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(
            let(places(found), lambda ordered: let(twice(ordered), covered))))


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word),
    ``n_dup_lines`` and ``n_repeat_words`` (longs, 0 for null texts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = docs.withColumns({
        "__words": words_of(F.col("text")),
        "__lines": F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(WHITE))) > 0)})
    bare = bare.withColumn("__shown", F.array_join("__words", ""))
    long = lambda column: column.cast("long")
    return bare.withColumns({
        "n_words": long(F.size("__words")),
        "word_chars": long(F.char_length("__shown")),
        "n_symbols": long(F.char_length(F.regexp_replace("__shown", f"[^{SYMBOLS}]+", ""))),
        "n_lines": long(F.size("__lines")),
        "n_dup_lines": long(F.size("__lines") - F.size(F.array_distinct("__lines"))),
        "n_repeat_words": repeated_words(F.col("__words")),
    }).drop("__words", "__lines", "__shown")


#: Rules on the counts of a document; true where it fails.
RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}


def host_verdicts(counted: DataFrame, host: str = "source",
                  limits: tuple[float, float] = HOST_LIMITS) -> DataFrame:
    """One row per host (null is one of its own): ``host``, ``n_docs`` and for each rule its
    failures ``f_*`` and shrunk rate ``r_*``; ``rejected`` if any rate is beyond what the prior
    of its rule has hosts do (see ``PRIOR_DEVIATIONS``)."""
    fails = {rule: F.expr(test).cast("long") for rule, test in RULES.items()}
    hosts = written(counted.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *[F.sum(x).alias(f"f_{r}") for r, x in fails.items()]), "hosts")
    rate = {r: F.col(f"f_{r}") / F.col("n_docs") for r in RULES}
    moments = hosts.agg(F.sum("n_docs").alias("n"), *[x for r in RULES for x in (
        F.sum(f"f_{r}").alias(f"f_{r}"), F.var_samp(rate[r]).alias(f"v_{r}"))]).first()
    rates, beyond = {}, []
    for r in RULES:
        mean = (moments[f"f_{r}"] or 0) / (moments["n"] or 1)
        spread = moments[f"v_{r}"] or 0.0
        weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_WEIGHT[1]
        weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
        rates[f"r_{r}"] = (F.col(f"f_{r}") + mean * weight) / (F.col("n_docs") + weight)
        deviation = (mean * (1 - mean) / (weight + 1)) ** 0.5
        beyond.append(F.col(f"r_{r}") > min(max(mean + PRIOR_DEVIATIONS * deviation, limits[0]), limits[1]))
    return hosts.withColumns(rates).withColumn("rejected", reduce(lambda a, b: a | b, beyond))


def judge(docs: DataFrame, host: str = "source",
          limits: tuple[float, float] = HOST_LIMITS) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed`` (fewer than 10 words, or
    over a fifth of them repeated) and ``kept`` (false if ``base_failed`` or if the host is
    rejected).

    Null and blank texts have no words and fail. Documents without host share the null
    host. Repeated rows count as often as they come; other columns are not read. An
    empty table gives an empty one.
    """
    counted = written(with_counts(docs.select("doc_id", "text", F.col(host).alias("host")))
                      .drop("text"), "counts")
    out = host_verdicts(counted, "host", limits).where("rejected").select(
        F.col("host").alias("bad_host"), "rejected")
    met = counted.join(out, counted["host"].eqNullSafe(out["bad_host"]), "left")
    failed = F.expr(f"{RULES['few_words']} OR {RULES['repeats']}")
    return met.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"),
                      (~failed & ~F.coalesce("rejected", F.lit(False))).alias("kept"))
