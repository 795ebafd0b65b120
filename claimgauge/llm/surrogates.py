"""Surrogates for personal data (DataFrame functions only).

Entities are found by pattern, brought to a canonical form in which all spellings of one
entity agree, and given a keyed replacement of the same type and format: digits for
digits, letters of the same case for letters, card numbers with a valid check digit,
addresses of four octets, names of the same gender and script. Replacements are checked
against each other and against all originals, and drawn again where they collide; so
different entities stay different and mentions of one stay the same, in all documents. A name's parts are replaced each by itself, so a person
has one surname in full and in short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import ROW_KEY, let, same_row, with_row_key, written

#: Draws in the format of the original; later ones carry digits of the hash as a suffix.
DRAWS = 12

#: Forms of address by the gender they state.
TITLES = {"m": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин"],
          "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña",
                "Госпожа"],
          "": ["Dr", "Prof"]}
#: Given names by script and gender.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin",
                     "Oscar", "Paul", "Simon", "Thomas", "Victor", "Walter"],
    ("latin", "f"): ["Alice", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia",
                     "Laura", "Marta", "Nora", "Olivia", "Paula", "Rosa", "Sofia"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Денис", "Иван", "Михаил", "Олег", "Павел"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
}
#: Syllables that surnames are made of.
SYLLABLES = {"latin": ["ba", "ber", "da", "del", "fa", "gar", "han", "kel", "la", "man", "mor", "na", "ran",
                       "ros", "ta", "ver"],
             "cyrillic": ["ба", "вер", "го", "да", "кел", "ла", "ман", "нов", "ра", "рос", "та", "фа"]}

_TITLED = "|".join(f"{t}\\.?" for titles in TITLES.values() for t in titles)
_WORD = r"\p{Lu}[\p{L}'’-]*\p{L}"
#: Patterns by type, in the order in which they are tried at a place of the text.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
          r"(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}"
             r"(?![0-9])|(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<=(?i:password|passwd|token|secret|api[_-]?key) {0,2}[=:] {0,2}[\"']?)[A-Za-z0-9_+/-]{8,}",
    "name": rf"(?<=(?<!\p{{L}})(?:{_TITLED}) )(?!(?:{_TITLED}) ){_WORD}(?: {_WORD})?",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must have for any pattern to match; cheap to look for.
_HINT = r"[0-9@]|[=:] {0,2}[\"']?[A-Za-z_+/-]{8}|" + "|".join(
    t for titles in TITLES.values() for t in titles)


def type_of(mention: Column) -> Column:
    """Type of a found mention by its own form; what has none of the others' is a secret.
    Names have letters only and begin with a capital."""
    kind = F.when(mention.rlike(rf"^{_WORD}(?: {_WORD})?$"), "name").otherwise("secret")
    for name in ("phone", "card", "ssn", "ip", "access_key", "iban", "email"):
        kind = F.when(mention.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def canonical(kind: Column, mention: Column) -> Column:
    """The form in which all spellings of an entity agree."""
    return (F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
            .when(kind == "iban", F.regexp_replace(mention, " ", ""))
            .when(kind == "email", F.lower(mention)).otherwise(mention))


def _hex(key: str, *parts: Column) -> Column:
    """128 hex digits keyed by ``key``."""
    whole = F.concat_ws("\u0000", F.lit(key), *[p.cast("string") for p in parts])
    return F.concat(*[F.sha2(F.concat(whole, F.lit(f"\u0000{i}")).cast("binary"), 256) for i in (0, 1)])


def _nth(digest: Column, at: Column) -> Column:
    """A number below 65,536 from the hash; ``at`` counts from 0 and wraps around."""
    start = F.pmod(at, F.lit(31)) * 4 + 1
    return F.conv(F.substring(digest, start, F.lit(4)), 16, 10).cast("int")


def _like(value: Column, digest: Column, keep: Column) -> Column:
    """``value`` with every digit and letter behind the first ``keep`` characters drawn anew:
    digits stay digits, letters keep their case; a hexadecimal value stays hexadecimal."""
    letters = F.when(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), 6).otherwise(26)

    def one(char: Column, at: Column) -> Column:
        drawn = _nth(digest, at)
        letter = F.char(drawn % letters + F.lit(97))
        return (F.when(at < keep, char).when(char.rlike("[0-9]"), (drawn % 10).cast("string"))
                .when(char.rlike("[a-z]"), letter).when(char.rlike("[A-Z]"), F.upper(letter))
                .otherwise(char))

    return F.array_join(F.transform(F.split(value, ""), one), "")


def luhn_total(digits: Column) -> Column:
    """Luhn sum of a string of digits; a valid number's is a multiple of 10."""
    def add(total: Column, pair: Column) -> Column:
        twice = pair["d"] * 2
        return total + F.when(pair["i"] % 2 == 0, pair["d"]).when(twice > 9, twice - 9).otherwise(twice)

    pairs = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(
        d.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(pairs, F.lit(0), add)


def _card(value: Column, digest: Column) -> Column:
    """Card number with the first digit of the original and a check digit that fits."""
    body = _like(F.substring(value, F.lit(1), F.length(value) - 1), digest, F.lit(1))
    return let(body, lambda b: F.concat(
        b, F.pmod(10 - luhn_total(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))


def _ip(digest: Column) -> Column:
    return F.concat_ws(".", *[(_nth(digest, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])


def _pick(choices: list[str], drawn: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in choices]), drawn % len(choices))


def _syllables(script: str, digest: Column, n: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _pick(
        SYLLABLES[script], _nth(digest, i + 1))), "")


def _surname(value: Column, digest: Column) -> Column:
    """A surname in the script of the original; more syllables on later draws."""
    of = {script: F.initcap(_syllables(script, digest, F.col("draw") + 3)) for script in SYLLABLES}
    return F.when(value.rlike(r"\p{IsCyrillic}"), of["cyrillic"]).otherwise(of["latin"])


def _given(value: Column, gender: Column, digest: Column) -> Column:
    """A given name of the script and gender; later draws lengthen it by syllables."""
    def of(script: str) -> Column:
        female = F.when(gender == "", F.pmod(_nth(digest, F.lit(0)), F.lit(2)) == 0).otherwise(gender == "f")
        plain = F.when(female, _pick(GIVEN[script, "f"], _nth(digest, F.lit(1)))).otherwise(
            _pick(GIVEN[script, "m"], _nth(digest, F.lit(1))))
        return F.when(F.col("draw") == 0, plain).otherwise(
            F.concat(plain, _syllables(script, digest, F.col("draw"))))

    return F.when(value.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def draw(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (``kind``, ``gender``, ``canon``, ``draw``) plus ``surrogate`` of that draw."""
    digest = F.col("digest")
    kind, canon = F.col("kind"), F.col("canon")
    domain = F.concat(F.lit("@"), F.substring_index(canon, "@", -1))
    top = F.concat(F.lit("."), F.substring_index(canon, ".", -1))
    made = (F.when(kind == "card", F.when(luhn_total(canon) % 10 == 0, _card(canon, digest))
                   .otherwise(_like(canon, digest, F.lit(1))))
            .when(kind == "phone", _like(canon, digest, F.greatest(F.lit(1), F.length(canon) - 10)))
            .when(kind == "ip", _ip(digest))
            .when(kind == "access_key", _like(canon, digest, F.lit(4)))
            .when(kind == "iban", _like(canon, digest, F.lit(2)))
            .when(kind == "email", F.concat(
                _like(F.substring_index(canon, "@", 1), digest, F.lit(0)),
                _like(F.substring(domain, F.lit(1), F.length(domain) - F.length(top)),
                      F.reverse(digest), F.lit(0)), top))
            .when(kind == "surname", _surname(canon, digest))
            .when(kind == "given", _given(canon, F.col("gender"), digest))
            .otherwise(_like(canon, digest, F.lit(0))))
    late = F.when(F.col("draw") >= DRAWS, F.concat(
        F.when(kind == "email", F.concat(F.lit("x"), F.substring(digest, 1, 8), made))
        .otherwise(F.concat(made, F.translate(F.substring(digest, 1, 8), "abcdef", "012345"))))
    ).otherwise(made)
    return (entities.withColumn("digest", _hex(key, kind, F.col("gender"), canon, F.col("draw")))
            .withColumn("surrogate", late).drop("digest"))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canon``, ``surrogate``: one surrogate for each entity, of a kind all different
    and none equal to an original.

    ``entities`` has ``kind``, ``gender`` and ``canon``, distinct in kind and canon. Of those that
    draw the same surrogate the first by canon keeps it; the rest draw again.
    """
    originals = entities.select("kind", F.col("canon").alias("surrogate"))
    accepted: list[DataFrame] = []
    open_, turn = entities, 0
    while True:
        drawn = written(draw(open_.withColumn("draw", F.lit(turn)), key), "drawn")
        used = reduce(DataFrame.unionByName, [x.select("kind", "surrogate") for x in accepted], originals)
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).join(
            used, ["kind", "surrogate"], "left_anti")
        settled = written(first.select("kind", "canon", "surrogate"), "settled")
        accepted.append(settled)
        open_ = written(drawn.select("kind", "gender", "canon").join(
            settled, ["kind", "canon"], "left_anti"), "colliding")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, accepted)
        turn += 1


def with_names(entities: DataFrame, key: str) -> DataFrame:
    """As ``surrogate_table``, but names get theirs by parts: the surname's from the surname alone,
    so that full and short forms of a person agree, the given name's from the given name.
    Each part is replaced one to one, so different full names stay different."""
    names = entities.where(F.col("kind") == "name").select(
        "canon", "gender", F.substring_index("canon", " ", -1).alias("last"),
        F.when(F.col("canon").contains(" "), F.substring_index("canon", " ", 1)).alias("first"))
    parts = names.select(F.lit("surname").alias("kind"), F.lit("").alias("gender"), F.col("last").alias("canon")
                         ).unionByName(names.where(F.col("first").isNotNull()).select(
                             F.lit("given").alias("kind"), "gender", F.col("first").alias("canon")))
    parts = parts.groupBy("kind", "canon").agg(F.max("gender").alias("gender"))
    settled = surrogate_table(entities.where(F.col("kind") != "name").unionByName(parts), key)
    last = settled.where(F.col("kind") == "surname").select(
        F.col("canon").alias("last"), F.col("surrogate").alias("new_last"))
    first = settled.where(F.col("kind") == "given").select(
        F.col("canon").alias("first"), F.col("surrogate").alias("new_first"))
    whole = names.join(last, "last").join(first, "first", "left").select(
        F.lit("name").alias("kind"), "canon", F.concat_ws(" ", "new_first", "new_last").alias("surrogate"))
    return settled.where(~F.col("kind").isin("surname", "given")).unionByName(whole)


def poured(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of the mention: separators and case as there."""
    def step(state: Column, char: Column) -> Column:
        own = char.rlike("[0-9A-Za-z]")
        return F.struct(
            F.concat(state["out"], F.when(own, F.substring(state["rest"], 1, 1)).otherwise(char)).alias("out"),
            F.when(own, F.substring(state["rest"], F.lit(2), F.length(state["rest"]))).otherwise(
                state["rest"]).alias("rest"))

    filled = F.aggregate(F.split(mention, ""), F.struct(F.lit("").alias("out"), surrogate.alias("rest")),
                         step, lambda s: F.concat(s["out"], s["rest"]))
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), filled)
            .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate))
            .otherwise(surrogate))


def mentions(docs: DataFrame) -> DataFrame:
    """``ROW_KEY``, ``at`` (0 for the first mention of a text), ``mention``, ``kind``, ``gender``, ``canon``."""
    found = with_row_key(docs).where(F.col("text").rlike(_HINT)).select(
        *ROW_KEY, F.posexplode(F.arrays_zip(
            F.regexp_extract_all("text", F.lit(_ANY), F.lit(0)).alias("mention"),
            F.transform(F.split("text", _ANY, -1), lambda p: F.substring(p, -12, 12)).alias("before")
        )).alias("at", "pair")).where(F.col("pair.mention").isNotNull()).select(
        *ROW_KEY, "at", F.col("pair.mention").alias("mention"), F.col("pair.before").alias("before"))
    kind = type_of(F.col("mention"))
    gender = F.lit("")
    for sign in ("m", "f"):
        gender = F.when(F.col("before").rlike(
            rf"(?<!\p{{L}})(?:{'|'.join(TITLES[sign])})\.? $"), sign).otherwise(gender)
    typed = found.withColumn("kind", kind)
    return typed.select(*ROW_KEY, "at", "mention", "kind",
                        F.when(F.col("kind") == "name", gender).otherwise("").alias("gender"),
                        canonical(F.col("kind"), F.col("mention")).alias("canon"))


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every found entity of ``text`` replaced, and ``n_entities`` (int).

    The same ``key`` gives the same surrogates to the same set of entities. A person named
    behind a title is replaced wherever the same document names them. Null texts stay
    null and texts without entities as they are, with 0 entities; repeated rows come out
    alike. A column ``n_entities`` is replaced, other columns are untouched.
    """
    found = written(mentions(docs).distinct(), "mentions")
    entities = written(found.groupBy("kind", "canon").agg(F.max("gender").alias("gender")), "entities")
    table = with_names(entities, key).select(
        F.col("kind").alias("of_kind"), F.col("canon").alias("of_canon"), "surrogate")
    replaced = found.join(table, (found["kind"] == table["of_kind"])
                          & (found["canon"] == table["of_canon"])).select(
        *ROW_KEY, F.struct("at", poured(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("new"),
                           F.when(F.col("kind") == "name", F.col("mention")).alias("name"),
                           F.col("surrogate")).alias("one"))
    by_text = replaced.groupBy(*ROW_KEY).agg(F.sort_array(F.collect_list("one")).alias("__new"))
    keyed = with_row_key(docs)
    hint = F.coalesce(F.col("text").rlike(_HINT), F.lit(False))
    plain = keyed.where(~hint).withColumn("n_entities", F.lit(0))
    rest = keyed.where(hint)
    met = rest.join(by_text, same_row(rest, by_text), "left").select(
        *[rest[c] for c in keyed.columns], "__new")
    pieces = F.split("text", _ANY, -1)
    woven = F.array_join(F.transform(F.arrays_zip(pieces.alias("a"), F.col("__new.new").alias("b")),
                                     lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")))), "")
    # longer names first: a full name must be met before its last word is replaced
    names = F.sort_array(F.array_distinct(F.transform(
        F.filter("__new", lambda x: x["name"].isNotNull()), lambda x: F.struct(
            (-F.char_length(x["name"])).alias("shorter"), x["name"].alias("old"),
            x["surrogate"].alias("new")))))
    again = F.aggregate(names, woven, lambda text, n: F.regexp_replace(
        text, F.concat(F.lit(r"(?<!\p{L})\Q"), n["old"], F.lit(r"\E(?!\p{L})")), n["new"]))
    changed = met.withColumn("text", F.when(F.col("__new").isNull(), F.col("text")).otherwise(again))
    changed = changed.withColumn("n_entities", F.coalesce(F.size("__new"), F.lit(0))).drop("__new")
    columns = [*docs.columns, *([] if "n_entities" in docs.columns else ["n_entities"])]
    return plain.select(*columns).unionByName(changed.select(*columns))
