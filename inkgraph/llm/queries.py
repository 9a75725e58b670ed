"""Registered queries of the numbered operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph.llm import (
    bpe, language, licences, lm_bloom, multi_index, near_duplicates, packing, secret_scan, top_k, toxicity, url_filters,
    filter_audit, lexical_search,
)
from inkgraph.llm.common import fold, table


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_inner_products(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode(table(spark, folder, "documents"), path), path)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    return language.identify(docs, ~F.col("held_out"), "held_out")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = lm_bloom.score(docs, fold("doc_id", 5) != 1)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    model = toxicity.learn(docs, table(spark, folder, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model, "held_out")


def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(table(spark, folder, "pages"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_licences": op2_licences,
    "op3_packing": op3_packing,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_nearest": op8_nearest,
    "op9_lm_scores": op9_lm_scores,
    "op10_toxicity": op10_toxicity,
    "op11_url_filters": op11_url_filters,
    "op12_lexical_search": op12_lexical_search,
    "op13_filter_audit": op13_filter_audit,
}

VALID = """
valid AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

ORACLES = {
    "op1_top_k": f"""
WITH {VALID},
whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM valid),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op2_licences": licences.sql(),
    "op11_url_filters": url_filters.sql(),
    "op12_lexical_search": lexical_search.sql(),
    "op13_filter_audit": filter_audit.sql(),
    "op7_near_duplicates": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
either_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reached r JOIN either_way e ON r.b = e.a),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
}
