"""URL verdicts: given host and path rules first, then association rules mined by
FP-growth from labelled pages (DataFrame functions only).

A mined rule is a set of URL tokens that labelled pages to be blocked have together. It
is filed in an inverted index under its rarest token; a URL looks up its tokens there
and is held against whole rules only where one of them meets.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import written

#: (verdict, host, path), fixed by contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: A mined rule must hold for this share and number of labelled pages, with this confidence.
LEAST_SUPPORT = 0.0005
LEAST_PAGES = 20
LEAST_CONFIDENCE = 0.8
BLOCKED = "label=block"

_HOST_PATH = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 2)


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule`` (host and path as one string), ``verdict`` of the longest rule that
    fits the host or a parent domain of it and begins the path; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, where, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(where + start).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a whole URL: scheme, host labels, path segments (digits written as
    ``0``) and query keys, however many; empty without ``://``."""
    host, path = url_host(url), url_path(url)
    labels = F.array_remove(F.split(host, r"\."), "")
    segments = F.array_remove(F.split(F.regexp_replace(path, r"\d+", "0"), "/"), "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.array_remove(F.transform(
        F.split(query, "&"), lambda pair: F.substring_index(pair, "=", 1)), "")
    tokens = F.array_distinct(F.concat(
        F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1))),
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("p:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), x))))
    return F.when(F.coalesce(url.contains("://"), F.lit(False)), tokens).otherwise(
        F.array().cast("array<string>"))


def _baskets(pages: DataFrame, known: DataFrame, least: int | float) -> tuple[DataFrame, DataFrame, int]:
    """Baskets of labelled pages (``items``), the uses of their tokens, and their number.

    Tokens on fewer than the least number of pages take part in no rule and are left out. Of tokens that are always on the same pages (the labels of one host, the steps
    of one path) the least stands for all: sets of them would be as many as their
    subsets, and say the same.
    """
    rows = written(
        pages.where(F.col("url").isNotNull()).select("page_id", url_tokens(F.col("url")).alias("tokens"))
        .where(F.size("tokens") > 0).join(known, "page_id")
        .withColumn("row", F.monotonically_increasing_id()), "tokens")
    total = rows.count()
    spread = rows.select("row", F.explode("tokens").alias("token"))
    uses = spread.groupBy("token").agg(
        F.count("*").alias("uses"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("where"))
    uses = uses.where(F.col("uses") >= least)
    kept = written(uses.groupBy("uses", "where").agg(F.min("token").alias("token")), "uses")
    items = spread.join(kept.select("token"), "token").groupBy("row").agg(
        F.collect_list("token").alias("tokens"))
    baskets = written(rows.select("row", "bad").join(items, "row").select(
        F.when(F.col("bad") == 1, F.concat("tokens", F.array(F.lit(BLOCKED))))
        .otherwise(F.col("tokens")).alias("items")), "baskets")
    return baskets, kept.select("token", "uses"), total


def mined_rules(pages: DataFrame, labels: DataFrame, support: float = LEAST_SUPPORT,
                least_pages: int = LEAST_PAGES, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """``(tokens, confidence, key)``: token sets whose labelled pages (``page_id`` is the
    labels' ``doc_id``) are toxic or of low quality in at least ``confidence`` of the
    cases; ``key`` is the rarest token. Rules that only narrow another are left out."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.coalesce(F.col("toxic") == 1, F.lit(False))
               | F.coalesce(F.col("quality") == 0, F.lit(False))).cast("int")).alias("bad"))
    labelled = pages.where(F.col("url").isNotNull()).join(known, "page_id", "left_semi").count()
    rules_schema = "tokens array<string>, confidence double, key string"
    if not labelled:
        return pages.sparkSession.createDataFrame([], rules_schema)
    baskets, use, total = _baskets(pages, known, max(support * labelled, least_pages, 1))
    if not total:
        return pages.sparkSession.createDataFrame([], rules_schema)
    least = min(1.0, max(support, least_pages / total))
    # the support is a share of the baskets, from which pages without a frequent token are missing
    left = baskets.count()
    if not left or least * total > left:
        return pages.sparkSession.createDataFrame([], rules_schema)
    model = FPGrowth(itemsCol="items", minSupport=least * total / left,
                     minConfidence=confidence).fit(baskets)
    found = written(model.associationRules.where(
        (F.size("consequent") == 1) & (F.element_at("consequent", 1) == BLOCKED)).select(
            F.array_sort("antecedent").alias("tokens"), "confidence"), "rules")
    rarest = (found.select("tokens", "confidence", F.explode("tokens").alias("token"))
              .join(use, "token").groupBy("tokens", "confidence")
              .agg(F.min_by("token", F.struct("uses", "token")).alias("key")))
    keyed = written(rarest, "keyed-rules")
    tokens = keyed.select(F.explode("tokens").alias("key"), F.col("tokens").alias("larger"))
    narrow = tokens.join(keyed.select("key", "tokens"), "key").where(
        (F.size("tokens") < F.size("larger")) & (F.size(F.array_except("tokens", "larger")) == 0))
    return keyed.join(narrow.select(F.col("larger").alias("tokens")).distinct(), "tokens", "left_anti")


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, **limits) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are
    replaced), and ``confidence`` of the best mined rule that fits, null without one.

    A given rule decides first; else ``block`` if a mined rule fits, ``allow`` otherwise. A
    null URL or one without ``://`` has an empty host and path and is allowed. Repeated
    rows get the same answer each.
    """
    mined = mined_rules(pages, labels, **limits)
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct().withColumn(
        "__tokens", url_tokens(F.col("url")))
    met = urls.select("url", "__tokens", F.explode("__tokens").alias("key")).join(mined, "key").where(
        F.size(F.array_except("tokens", "__tokens")) == 0)
    best = met.groupBy("url").agg(F.max("confidence").alias("__confidence"))
    # null URLs meet nothing and stay where they are
    given = pages.where(F.col("url").isNotNull()).join(best, "url", "left")
    judged = given.unionByName(pages.where(F.col("url").isNull()), allowMissingColumns=True).withColumns({
        "host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    judged = judged.withColumn("__rule", given_rule(F.col("host"), F.col("path"), rules))
    return judged.withColumns({
        "rule": F.col("__rule.rule"), "confidence": F.col("__confidence"),
        "verdict": F.coalesce("__rule.verdict", F.when(F.col("__confidence").isNotNull(), "block")
                              .otherwise("allow"))}).drop("__rule", "__confidence")
