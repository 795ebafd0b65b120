"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Documents and benchmark items are written as templates: numbers, units behind them and
names inside sentences become typed placeholders, the rest is lower-cased and bare of
punctuation. Windows of five template tokens are hash-joined. Where enough windows
of an item are found in a document, the two are aligned and the values in the slots
compared: one item value must stand for one document value throughout. So a question with
other numbers and names is caught, while a text that only shares its form is not.

A window of placeholders alone has no form: every table of numbers would meet every such item.
It is hashed by its values instead, and counts only for items that have no other window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import ROW_KEY, WHITE, same_row, with_row_key, words_of, written

WINDOW = 5
#: Share of an item's windows that a document must have.
COVERAGE = 0.5
#: Windows of all items that may be broadcast.
BROADCAST_WINDOWS = 1_000_000
#: Placeholders: single characters that texts do not otherwise have.
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
_PUNCTUATION = r"[!-/:-@\[-`{-~]+"

#: Units of measure that count as slots behind a number.
UNITS = ("mm cm m km in ft yd mi miles mile meters metres kilometers kilometres inches feet "
         "mg g kg lb lbs oz tons pounds grams kilograms ounces ml l liters litres gallons "
         "s sec secs min mins h hr hrs seconds minutes hours days weeks months years second "
         "minute hour day week month year dollars cents euros usd eur gbp percent degrees "
         "mph kmh kph w kw kwh v hz khz mhz ghz kb mb gb tb").split()

# A token that is a number, perhaps signed, grouped, in brackets, with a currency or percent.
_NUMBER = r"(?<![^\s])[(\"'$€£+\-]*[0-9][0-9.,:/]*%?[)\"'.,;:!?]*(?![^\s])"
_UNIT = rf"(?<={NUMBER}[ \t\n])(?:{'|'.join(UNITS)})(?=[.,;:!?)]*(?:\s|$))"
# A space and a capitalised word behind a word that ends no sentence.
_NAME = r" (?<=[\p{Ll}0-9,;] )\p{Lu}[\p{Ll}]+(?=[\p{Punct}\s]|$)"


# Only a text that this matches can have a slot.
_SLOT_HINT = rf"[0-9]|{_NAME}"


def raw_tokens(text: Column) -> Column:
    """Words without ASCII punctuation, as they are written."""
    own = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{NUMBER}{NAME}{UNIT}]", "")
    return words_of(F.regexp_replace(own, _PUNCTUATION, ""))


def template_tokens(text: Column) -> Column:
    """Template of a text, token by token in step with ``raw_tokens``. Placeholder
    characters of the text itself are taken out first."""
    own = F.coalesce(text, F.lit(""))
    own = F.when(own.rlike(f"[{NUMBER}{NAME}{UNIT}]"), F.translate(own, NUMBER + NAME + UNIT, "")).otherwise(own)
    marked = F.regexp_replace(own, _NAME, " " + NAME)
    marked = F.when(marked.rlike("[0-9]"), F.regexp_replace(
        F.regexp_replace(marked, _NUMBER, NUMBER), f"(?i){_UNIT}", UNIT)).otherwise(marked)
    return words_of(F.regexp_replace(F.lower(marked), _PUNCTUATION, ""))


def windows_of(tokens: Column, raw: Column, window: int = WINDOW) -> Column:
    """Windows of template tokens in order: ``hash``, and ``said``, their words as written,
    for windows with a slot (else null). The hash is of the tokens, or of the values if there is no
    other token. ``raw`` may be null for a text without slots."""
    count = F.size(tokens)
    part = lambda words, i: F.slice(words, i, window)
    slot = lambda x: x.isin(NUMBER, NAME, UNIT)
    said = lambda i: F.when(raw.isNotNull() & F.exists(part(tokens, i), slot), part(raw, i))
    key = lambda i: F.when(raw.isNotNull() & F.forall(part(tokens, i), slot),
                           F.transform(part(raw, i), F.lower)).otherwise(part(tokens, i))
    return F.when(count >= window, F.transform(
        F.sequence(F.lit(1), F.greatest(count - (window - 1), F.lit(1))),
        lambda i: F.struct(F.xxhash64(key(i)).alias("hash"), said(i).alias("said")))
    ).otherwise(F.array().cast("array<struct<hash: bigint, said: array<string>>>"))


def _has_form(tokens: Column) -> Column:
    return F.exists(tokens, lambda x: ~x.isin(NUMBER, NAME, UNIT))


def _item_templates(benchmark: DataFrame, window: int) -> DataFrame:
    """One row per distinct item: id, tokens raw and as template, its windows and whether they have
    a form. Windows without count only if the item has no others."""
    places = F.when(F.size("item_tokens") >= window, F.sequence(
        F.lit(1), F.greatest(F.size("item_tokens") - (window - 1), F.lit(1))))
    formed = F.size(F.filter(places, lambda i: _has_form(F.slice("item_tokens", i, window))))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(
        F.col("text").isNotNull()).distinct()
    return written(
        items.select("item_id", F.xxhash64("text").alias("item_hash"),
                     raw_tokens(F.col("text")).alias("item_raw"),
                     template_tokens(F.col("text")).alias("item_tokens"))
        .where(F.size("item_tokens") >= window)
        .withColumn("formed", formed > 0)
        .withColumn("windows", F.when(F.col("formed"), formed).otherwise(F.size(places))), "items")


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       coverage: float = COVERAGE) -> DataFrame:
    """Pairs of documents and the items they contain: ``ROW_KEY``, ``item_id``, ``item_hash``,
    ``windows`` (of the item), ``matched`` (of them in the document), ``offset`` (token of
    the document at which the item begins), ``slots`` (aligned values), ``changed`` (those
    that differ).

    A pair has at least ``coverage`` of the item's windows, and slot values that agree:
    wherever the item repeats a value, the document repeats its own. They are judged for
    each offset that has ``coverage`` of the windows, or the most of any if an item is
    scattered; of those that agree the one with most windows, then the first, is given.
    Windows of placeholders alone are not counted, but for items that have no other ones; those
    are found by their values, so only as they are.
    Items and documents of fewer than ``window`` tokens, null and empty texts are in no
    pair. Items without id still count. Rows alike in id and text give one pair. Empty
    tables give none.
    """
    items = _item_templates(benchmark, window)
    places = items.select("item_id", "item_hash", "item_tokens", "formed", F.posexplode(windows_of(
        F.col("item_tokens"), F.col("item_raw"), window)).alias("item_at", "one")).select(
            "item_id", "item_hash", "item_at", "one.hash", "formed",
            F.slice("item_tokens", F.col("item_at") + 1, window).alias("form"),
            F.col("one.said").alias("item_said"))
    places = places.where(~F.col("formed") | _has_form(F.col("form"))).drop("formed")
    tokens = with_row_key(docs).select(*ROW_KEY, template_tokens(F.col("text")).alias("tokens"), F.when(
        F.col("text").rlike(_SLOT_HINT), raw_tokens(F.col("text"))).alias("raw"))
    # Windows of a document take their values along, so its text is not needed again.
    found = tokens.select(*ROW_KEY, F.posexplode(windows_of(
        F.col("tokens"), F.col("raw"), window)).alias("at", "one")).select(
            *ROW_KEY, "at", "one.hash", "one.said")
    # Up to the bound (some 100 bytes a window) the items' windows are broadcast; beyond it
    # both sides are shuffled by hash, and frequent windows are split at run time.
    if (items.agg(F.sum("windows")).first()[0] or 0) <= BROADCAST_WINDOWS:
        places = F.broadcast(places)
    values = F.filter(
        F.transform(F.col("form"), lambda x, i: F.when(x.isin(NUMBER, NAME, UNIT), F.struct(
            (F.col("item_at") + i).alias("place"), F.lower(F.get("item_said", i)).alias("item"),
            F.lower(F.get("said", i)).alias("doc")))), lambda s: s.isNotNull())
    met = written(found.join(places, "hash").select(
        *ROW_KEY, "item_id", "item_hash", "item_at", (F.col("at") - F.col("item_at")).alias("offset"),
        F.when(F.col("said").isNotNull(), values).alias("values")).distinct(), "window-matches")
    pair = [*ROW_KEY, "item_id", "item_hash"]
    enough = (met.select(*pair, "item_at").distinct().groupBy(*pair)
              .agg(F.count("*").alias("matched")))
    lines = met.groupBy(*pair, "offset").agg(F.count("*").alias("n"), F.array_distinct(
        F.flatten(F.collect_list("values"))).alias("slots"))
    kinds = F.array_distinct(F.transform("slots", lambda s: F.struct(s["item"], s["doc"])))
    agree = F.size(kinds) == F.size(F.array_distinct(F.transform("slots", lambda s: s["item"])))
    # Each offset is judged by itself: a torn variant does not hide the item behind it.
    best = lines.groupBy(*pair).agg(F.max("n").alias("most"), F.max(F.when(agree, F.struct(
        "n", (-F.col("offset")).alias("back"), "slots"))).alias("best"))
    same_pair = lambda a, b: (same_row(a, b) & a["item_id"].eqNullSafe(b["item_id"])
                              & (a["item_hash"] == b["item_hash"]))
    aligned = enough.join(best, same_pair(enough, best)).select(
        *[enough[c] for c in pair], "matched", "most", "best")
    known = aligned.join(items, aligned["item_id"].eqNullSafe(items["item_id"])
                         & (aligned["item_hash"] == items["item_hash"])).select(
        *[aligned[c] for c in pair], "windows", "matched", (-F.col("best.back")).alias("offset"),
        "most", F.col("best.n").alias("n"), F.col("best.slots").alias("pairs"))
    least = coverage * F.col("windows")
    judged = (F.col("n") >= least) | (F.col("n") == F.col("most"))
    return known.where((F.col("matched") >= least) & judged).select(
        *pair, "windows", "matched", "offset", F.size("pairs").alias("slots"),
        F.size(F.filter("pairs", lambda s: s["item"] != s["doc"])).alias("changed"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that contain a benchmark item; columns stay as they are.

    Null and empty texts contain none and stay. Repeated rows stay or go together. An empty
    table stays empty; with an empty benchmark all rows stay. Very long texts are windowed
    whole. Columns named as those of
    ``ROW_KEY`` are the only ones that must not be there.
    """
    pairs = contaminated_pairs(docs, benchmark).select(*ROW_KEY).distinct()
    keyed = with_row_key(docs)
    return keyed.join(pairs, same_row(keyed, pairs), "left_anti").select(*docs.columns)
