"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.llm import (conversation_trie, decontamination, exact_copies, host_quality, language,
                            line_quality, mixing, periodic_runs, sharding, simhash, surrogates,
                            toxicity, url_rules)
from claimgauge.llm.common import held_out, table


def op1_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.histogram_shards(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op2_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language.with_language(docs, language.train(docs))
    return named.select("doc_id", held_out(F.col("doc_id"), language.FOLDS, language.FOLD)
                        .alias("held_out"), "lang_pred", "score")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (table(spark, sf_dir, name) for name in ("pages", "labels"))
    return url_rules.judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contaminated_pairs(docs, benchmark).select(
        F.col("__id").alias("doc_id"), "item_id", "windows", "matched", "offset", "slots", "changed")


def op5_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = toxicity.with_toxicity(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), toxicity.FOLDS, toxicity.FOLD).alias("held_out"),
        "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


#: Stands for the secret a deployment would hand in.
SURROGATE_KEY = "demonstration key"


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, SURROGATE_KEY)


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"),
                        simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    found = mixing.mix(docs, mixing.domain_labels(labels))
    return found.select("doc_id", "tokens", *[f"p_{d}" for d in mixing.TARGETS], "rate", "copies")


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = line_quality.with_quality(docs, line_quality.train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), line_quality.FOLDS, line_quality.FOLD).alias("held_out"),
        "score", (F.col("score") >= line_quality.THRESHOLD).cast("int").alias("predicted"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", periodic_runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[name].cast("string") for name in ("start", "length", "period")]))
    return (periodic_runs.with_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                    best["length"].alias("length"), best["period"].alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""),
                           256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    nodes = conversation_trie.trie_nodes(
        conversation_trie.rebuilt(conversation_trie.gathered(conversations)))
    return nodes.select(*[F.col(c) if c == "ends_sha256" else F.col(c).cast("long") for c in nodes.columns])


def op13_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {query.__name__: query for query in (
    op1_histogram_sharding, op2_ppm_language, op3_url_rules, op4_template_decontamination,
    op5_factorization_toxicity, op6_pii_surrogates, op7_simhash_components, op8_host_quality, op9_soft_mixing,
    op10_line_quality, op11_periodic_runs, op12_conversation_trie,
    op13_tree_merge_dedup)}

#: SQL of the queries above that SQL can express. The others rest on trained models, XXH64
#: or iterated graphs; tests/llm holds them against brute force or held-out labels.
ORACLES: dict[str, str] = {"op8_host_quality": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
win AS (
  SELECT rid, i, words[i:i + 4] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, 5)) AS k FROM dup)
  GROUP BY rid),
c AS (
  SELECT w.rid, doc_id, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (rid)),
f AS (
  SELECT *, (n_words < 10)::INT AS f1, (100 * n_repeat_words > 20 * n_words)::INT AS f2,
    (10 * n_symbols > word_chars)::INT AS f3, (100 * n_dup_lines > 30 * n_lines)::INT AS f4 FROM c),
h AS (
  SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS rule,
    unnest([sum(f1), sum(f2), sum(f3), sum(f4)]) AS failed FROM f GROUP BY source),
m AS (
  SELECT rule, sum(failed) / sum(n) AS mean, coalesce(var_samp(failed / n), 0) AS spread
  FROM h GROUP BY rule),
p AS (
  SELECT rule, mean, CASE WHEN spread > 0
    THEN least(greatest(mean * (1 - mean) / spread - 1, 1.0), 1000.0) ELSE 1000.0 END AS weight FROM m),
bad AS (
  SELECT source FROM h JOIN p USING (rule) GROUP BY source
  HAVING bool_or((failed + mean * weight) / (n + weight)
    > least(greatest(mean + 2 * sqrt(mean * (1 - mean) / (weight + 1)), 0.2), 0.5)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  f1 + f2 > 0 AS base_failed,
  f1 + f2 = 0 AND NOT EXISTS (
    SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source) AS kept
FROM f""",
    "op12_conversation_trie": r"""
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
-- CRC-32 of the decimal id, bit by bit
crc AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda k, z: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END))) % 4 AS h
  FROM own),
seq AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM crc a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
node AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM seq) GROUP BY 1, 2),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM node LEFT JOIN kids USING (path)),
under AS (
  SELECT path[1:d] AS path, sum((n_convs - 1) * words)::BIGINT AS saved_tokens,
    sum((n_children = 0)::INT)::BIGINT AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_node) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM full_node f JOIN under u ON u.path = f.path
LEFT JOIN node p ON f.depth > 0 AND p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]""",
    "op13_tree_merge_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER best = 1 AS kept, text_sha256
FROM d
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)"""}
