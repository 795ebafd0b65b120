"""Soft-membership mixing: document rates whose expected domain tokens match targets
(DataFrame functions only).

A softmax classifier, fitted on a bounded sample of a labelled table, gives every document
a probability for each domain. The rates are the solution of a least-squares problem over
all documents: the expected tokens of each domain against its target (relative to its
size), with a slight pull to rate 1, under rates of at least 0. It is solved by projected
gradient steps; each step is one aggregation over the documents that returns as many sums
as there are domains, and the rate of a document follows from its own probabilities and
the sums of the steps before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.common import (ROW_KEY, labelled_sample, same_row, with_row_key, words_of,
                                   written)

#: Target shares of tokens by domain; the first is the anchor.
TARGETS = {"prose": 0.95, "junk": 0.05}
#: The token budget lets the anchor domain have this rate, so that its documents stay.
HEADROOM = 1.01
#: Bound of the labelled sample, an equal share of each domain.
SAMPLE_ROWS = 3_000
#: Words per domain whose presence tells it from the others.
LEXICON = 48
STEPS = 40
TOLERANCE = 1e-4
CHAIN = 4
PULL = 1e-3
FEATURES = ("upper", "symbols", "digits", "word_length", "distinct", "lines", "size")


def domain_labels(labels: DataFrame) -> DataFrame:
    """Domain of each labelled document, by its quality."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, "junk")
                         .when(F.col("quality") == 1, "prose").alias("label"))


def with_features(docs: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """``ROW_KEY``, ``doc_id``, ``tokens`` and the features (doubles in 0 to 1) of each document;
    null texts are like empty ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # One pass takes the plain letters and spaces out; the other counts are on what is left.
    read = with_row_key(docs).select(
        *ROW_KEY, F.col("doc_id"), words_of(F.col("text")).alias("words"),
        F.regexp_replace(text, "[a-z ]+", "").alias("odd"), F.char_length(text).alias("chars"))
    read = read.withColumn("kinds", F.array_distinct("words"))
    count = lambda some: F.char_length(F.regexp_replace("odd", f"[^{some}]+", ""))
    whole, tokens = F.greatest("chars", F.lit(1)), F.size("words")
    at_most = lambda x: F.least(F.lit(1.0), x)
    return read.select(
        *ROW_KEY, "doc_id", tokens.cast("long").alias("tokens"),
        (count("A-Z") / whole).alias("upper"),
        at_most(4 * count(r"#*$%&|<>!=_~^\[\]{}") / whole).alias("symbols"),
        at_most(4 * count("0-9") / whole).alias("digits"),
        at_most(F.col("chars") / F.greatest(tokens, F.lit(1)) / 12).alias("word_length"),
        (F.size("kinds") / F.greatest(tokens, F.lit(1))).alias("distinct"),
        at_most(10 * count(r"\n") / whole).alias("lines"),
        at_most(F.log1p("chars") / 12).alias("size"),
        *[at_most(F.size(F.array_intersect("kinds", F.array(*[F.lit(w) for w in words] or [F.lit("")])))
                  / 3).alias(f"says_{domain}") for domain, words in lexicon.items()])


def learn_lexicon(sample: DataFrame, domains: list[str], size: int = LEXICON) -> dict[str, list[str]]:
    """Per domain the ``size`` words whose share of its sample texts is the most standard
    errors above their share of the others."""
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    words = sample.select("label", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    used = words.groupBy("word").agg(F.count("*").alias("all"), *[
        F.count(F.when(F.col("label") == d, 1)).alias(f"in_{i}") for i, d in enumerate(domains)])
    found = {}
    for i, d in enumerate(domains):
        own, others = max(1, sizes.get(d, 0)), max(1, sum(sizes.values()) - sizes.get(d, 0))
        share = F.col(f"in_{i}") / own - (F.col("all") - F.col(f"in_{i}")) / others
        top = used.where((F.col(f"in_{i}") >= 5) & (share > 0)).orderBy(
            F.desc(share / F.sqrt(F.col("all"))), "word").limit(size)
        found[d] = [r["word"] for r in top.collect()]
    return found


@dataclass
class Softmax:
    """``weights[domain][feature]`` and ``biases[domain]``; domains never seen have none."""

    domains: list[str]
    features: list[str]
    weights: dict[str, list[float]]
    biases: dict[str, float]

    def probabilities(self) -> dict[str, Column]:
        if len(self.weights) < 2:
            alone = list(self.weights) or self.domains
            return {d: F.lit(1 / len(alone) if d in alone else 0.0) for d in self.domains}
        scores = {d: sum((F.col(f) * float(w) for f, w in zip(self.features, self.weights[d])),
                         F.lit(float(self.biases[d]))) for d in self.weights}
        total = sum((F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), s)))
                     for s in scores.values()), F.lit(0.0))
        return {d: F.round(F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), scores[d]))) / total, 6)
                if d in scores else F.lit(0.0) for d in self.domains}


def train(featured: DataFrame, domains: list[str]) -> Softmax:
    """Softmax weights from rows with ``label``, ``weight`` and the features."""
    names = [c for c in featured.columns if c not in (*ROW_KEY, "doc_id", "tokens", "label", "weight")]
    present = [d for d in domains if not featured.where(F.col("label") == d).isEmpty()]
    if len(present) < 2:
        return Softmax(domains, names, {d: [0.0] * len(names) for d in present}, dict.fromkeys(present, 0.0))
    number = F.coalesce(*[F.when(F.col("label") == d, float(i)) for i, d in enumerate(present)])
    rows = VectorAssembler(inputCols=names, outputCol="x").transform(
        featured.withColumn("y", number)).select("x", "y", "weight")
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", maxIter=60,
                               regParam=1e-4, family="multinomial").fit(rows)
    table = model.coefficientMatrix.toArray()
    return Softmax(domains, names, {d: [float(w) for w in table[i]] for i, d in enumerate(present)},
                   {d: float(model.interceptVector[i]) for i, d in enumerate(present)})


def with_rates(members: DataFrame, targets: dict[str, float], headroom: float = HEADROOM,
               steps: int = STEPS, tolerance: float = TOLERANCE, pull: float = PULL) -> DataFrame:
    """``members`` (``tokens`` and ``p_<domain>``) plus ``rate``, at least 0, rounded to 6 places.

    The budget is ``headroom`` times the anchor's tokens over its target share. A domain
    without tokens cannot be met and is left out; without any tokens all rates are 1.
    Steps that follow from each other are one expression for ``CHAIN`` steps, then the
    rates so far are written.
    """
    domains = list(targets)
    state, rate = members.withColumn("rate", F.lit(1.0)), F.col("rate")
    tokens_of = lambda r: [F.coalesce(F.sum(F.col("tokens") * r * F.col(f"p_{d}")), F.lit(0.0))
                           .alias(d) for d in domains]
    mass = have = state.agg(*tokens_of(rate)).first()
    anchor = domains[0]
    if not mass[anchor] or not targets[anchor]:
        return state
    budget = headroom * mass[anchor] / targets[anchor]
    real = [d for d in domains if mass[d] > 0]
    pace, last = 1 / (1 + pull), None
    for step in range(1, steps + 1):
        short = {d: (have[d] - targets[d] * budget) / mass[d] for d in real}
        if last is not None and max(abs(short[d] - last[d]) for d in real) < tolerance:
            break
        last = short
        push = sum((F.col(f"p_{d}") * float(x) for d, x in short.items()), F.lit(-pull))
        rate = F.greatest(F.lit(0.0), rate * (1 - pace * pull) - pace * push)
        if step % CHAIN == 0:
            state, rate = written(state.withColumn("rate", rate), "mixing-rates"), F.col("rate")
        have = state.agg(*tokens_of(rate)).first()
    return state.withColumn("rate", F.round(rate, 6))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
        headroom: float = HEADROOM, seed: int = 29) -> DataFrame:
    """One row per document: ``ROW_KEY``, ``doc_id``, ``tokens`` (words), ``p_<domain>``, ``rate`` and
    ``copies``, the rate rounded up or down by a hash of the row, so that copies average
    to the rate.

    ``labelled`` has ``doc_id`` and ``label`` (a domain of ``targets``; others are ignored).
    Null and empty texts have no tokens and the rate of their probabilities. Rows alike in
    id and text get the same answer. Extra columns are not read; empty tables stay empty.
    """
    targets = targets or TARGETS
    domains = list(targets)
    sample = written(labelled_sample(docs, labelled, domains, SAMPLE_ROWS), "mixing-sample")
    lexicon = learn_lexicon(sample, domains)
    learnt = written(with_features(sample.withColumn("doc_id", F.col("__id")), lexicon)
                     .join(sample.select("__id", "label", "weight"), "__id"), "mixing-training")
    model = train(learnt, domains)
    featured = written(with_features(docs, lexicon), "mixing-features")
    members = featured.select(*ROW_KEY, "doc_id", "tokens", *[
        p.alias(f"p_{d}") for d, p in model.probabilities().items()])
    members = written(members, "mixing-members")
    draw = F.pmod(F.xxhash64(*ROW_KEY, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return (with_rates(members, targets, headroom)
            .withColumn("copies", F.floor(F.col("rate") + draw).cast("int")))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with each row as often as its ``copies`` say; columns stay as they are.

    Null and empty texts have no tokens and the rate of their posterior like any other; rows
    alike in id and text have the same number of copies each. An empty table stays empty.
    Columns named as those of ``ROW_KEY``, ``copies`` and ``__copy`` must not be there.
    """
    copies = mix(docs, labelled, targets).select(*ROW_KEY, "copies").distinct()
    keyed = with_row_key(docs)
    return (keyed.join(copies, same_row(keyed, copies))
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
            .select(*docs.columns))
