"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import chat, cross_polytope, kneser_ney, language, lexical, merkle, mixing, pieces, pii, sharding, simhash, sql, topk, toxicity
from riskspark.llm.common import fold, table, word_count

#: Model file of the tokenizer; SENTENCEPIECE_MODEL names another one.
MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")
    return views.withColumn("spans", spans)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.label(docs, docs.filter(fold(F.col("doc_id"), 3) != 1))
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole rows move; sizes are those of the texts that arrived.
    rows = mixing.marked(table(spark, sf_dir, "documents"))
    size = word_count(F.col("text"))
    return rows.select("doc_id", size.alias("size"), "_mix.source_size", "_mix.target", (F.col("_mix.copies") * size).cast("long").alias("taken"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), pieces.load(spark, MODEL))
    return found.select("doc_id", F.size("ids").alias("n_ids"), "ids", "exact")


def op7_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole rows move; the checksum is that of the text that arrived.
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = kneser_ney.judge(docs, kneser_ney.trusted_ids(table(spark, sf_dir, "labels")))
    return judged.select(F.col("id").alias("doc_id"), "lang", "perplexity", "threshold", "accepted")


def op9_cross_polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.label(docs, labels)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return merkle.manifest(table(spark, sf_dir, "documents"), changed={"text": lowered}, where=tampered)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    lines = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.col("digest").alias("base_sha256"), F.array_join(lines, ",").alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_language_id, op3_simhash_near_dedup, op4_source_mixing, op5_exact_topk,
        op6_sentencepiece, op7_histogram_sharding, op8_quality_classifier, op9_cross_polytope_search, op10_toxicity,
        op11_merkle_manifest, op12_ranked_search, op13_pii,
    )
}


def _chat_sql() -> str:
    head = "'<|im_start|>' || CASE WHEN who = 'system' THEN 'system' WHEN who = perspective THEN 'assistant' ELSE 'user name=' || who END || chr(10)"
    return f"""
WITH said AS (
  SELECT conv_id, turn,
    CASE WHEN coalesce(trim(role), '') = '' THEN 'unknown' ELSE trim(role) END AS who,
    replace(replace(coalesce(text, ''), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') AS body
  FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, who, body) - 1 AS place FROM said),
people AS (SELECT DISTINCT conv_id, who AS perspective FROM placed WHERE who <> 'system'),
pieces AS (
  SELECT p.conv_id, q.perspective, CAST(place // 64 AS INTEGER) AS part, place,
    {head} AS head, body || '<|im_end|>' AS body, who = perspective AS own
  FROM placed p JOIN people q ON p.conv_id IS NOT DISTINCT FROM q.conv_id),
spread AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY place) - length(body) - 1 AS start FROM pieces)
SELECT conv_id, perspective, part, min(place) AS first_turn, CAST(count(*) AS INTEGER) AS turns,
  string_agg(head || body || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(start + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (own), '') AS spans
FROM spread GROUP BY conv_id, perspective, part"""


def _mixing_sql(plan: mixing.Mixing = mixing.Mixing()) -> str:
    weights = "[" + ", ".join(map(str, plan.weights)) + "]"
    level = " + ".join(f"CASE WHEN size * {step} <= source_size THEN 1 ELSE 0 END" for step in mixing.LEVELS)
    text = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST({weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(plan.weights)} + 1] AS HUGEINT) AS w, {plan.most} * source_size AS cap FROM sums),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST) AS n, sum(source_size) OVER () AS total FROM weighed),
filled AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM ordered),
held AS (SELECT *, w * rest > cap * rest_w AS capped FROM filled),
level_ AS (SELECT max(total) - coalesce(sum(cap) FILTER (capped), 0) AS num, sum(w) FILTER (NOT capped) AS den FROM held),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
    CAST(CAST('0x' || substr(md5(coalesce('=' || source, 'null') || ':{plan.seed}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS shift
  FROM held, level_),
placed AS (
  SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS LAST) - 1 AS place FROM sized s),
docs AS (
  SELECT p.*, t.source_size, t.target, t.shift, {level} AS level
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
sums_by_level AS (SELECT source, level, count(*) AS n, sum(size) AS words, min(place) AS start FROM docs GROUP BY source, level),
state0 AS (SELECT source, target, source_size AS words_left, CAST(0.0 AS DOUBLE) AS next_base, CAST(0 AS HUGEINT) AS taken FROM targets)"""
    for k in range(len(mixing.LEVELS) + 1):
        text += f""",
rate{k} AS (
  SELECT s.*, l.n, l.words, l.start,
    CASE WHEN words_left > 0 THEN greatest(CAST(0.0 AS DOUBLE), least(CAST({plan.most} AS DOUBLE), (target - taken) / CAST(words_left AS DOUBLE))) ELSE 0.0 END AS rate
  FROM state{k} s LEFT JOIN sums_by_level l ON s.source IS NOT DISTINCT FROM l.source AND l.level = {k}),
copies{k} AS (
  SELECT d.*, CAST(floor(r.next_base + r.rate * CAST(place - r.start + 1 AS DOUBLE) + shift) - floor(r.next_base + r.rate * CAST(place - r.start AS DOUBLE) + shift) AS BIGINT) AS copies
  FROM docs d JOIN rate{k} r ON d.source IS NOT DISTINCT FROM r.source WHERE d.level = {k}),
state{k + 1} AS (
  SELECT r.source, r.target, words_left - coalesce(words, 0) AS words_left, next_base + rate * coalesce(n, 0) AS next_base,
    taken + coalesce((SELECT sum(copies * size) FROM copies{k} c WHERE c.source IS NOT DISTINCT FROM r.source), 0) AS taken
  FROM rate{k} r)"""
    union = " UNION ALL ".join(f"SELECT * FROM copies{k}" for k in range(len(mixing.LEVELS) + 1))
    return text + f"\nSELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(copies * size AS BIGINT) AS taken FROM ({union})"


ORACLES = {
    "op11_merkle_manifest": sql.manifest(),
    "op12_ranked_search": sql.ranked_search(),
    "op13_pii": sql.personal_data(),
    "op1_chat_formatting": _chat_sql(),
    "op4_source_mixing": _mixing_sql(),
    "op5_exact_topk": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
}
