"""A training corpus from the documents table: five stages, each on all that its predecessor kept.

language     texts in which no language can be told (null, empty, without letters) go; a missing lang is filled in
toxicity     texts scored 0.5 or more go
duplicates   one text of each group of near duplicates (similarity 0.80 or more) stays: the one with the smallest id
secrets      found secrets are masked in the text
packing      the texts are packed into training sequences: one row per piece
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph.llm import language, near_duplicates, packing, secret_scan, toxicity
from inkgraph.llm.common import fold, table
from inkgraph.session import cut

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is not ``und``."""
    seen = language.identify(docs, fold("doc_id", 4) != 2, *DOCUMENT[1:])
    known = seen.filter(F.col("lang_pred") != language.UNDETERMINED)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(DOCUMENT)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model, *DOCUMENT[1:]).filter("predicted = 0").select(DOCUMENT)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the one with the smallest id, rows without an id last.

    Components are those of rows, not of ids: different texts under one id, or
    under none, are told apart.  Rows without words are near duplicates of
    nothing; of those with the same id and text one stays.
    """
    rows = cut(docs.select(DOCUMENT).withColumn("row", F.monotonically_increasing_id()))
    keyed = rows.select(F.col("row").alias("doc_id"), "text")
    found = near_duplicates.near_duplicates(keyed, level=near_duplicates.STAGE)
    found = found.select(F.col("doc_id").alias("row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component"))
    own = found.join(rows.select("row", "doc_id", F.xxhash64("text").alias("text_key")), "row")
    wordless = F.when(F.col("component").isNull(), F.struct("doc_id", "text_key"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = own.groupBy("component", wordless.alias("wordless")).agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select(DOCUMENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets masked, n_chars counted anew."""
    return secret_scan.masked(docs.select(DOCUMENT))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("duplicates", duplicates_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None    # the learned stages and the tokenizer have no SQL form; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
