"""Cleaning, extraction, keyword scoring, TF-IDF and matching over the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.catalog.common import load, q, sql_clean, sql_keywords, sql_terms
from inkgraph.functions import arrays, text as tx
from inkgraph.operators import keywords, matching, tfidf

FEATURES = 15_000

# Function words and letter groups that tell the corpus languages apart.
LANGUAGE_WORDS = {
    "en": [" the ", " of ", " and ", " with ", " that "],
    "fr": [" le ", " la ", " des ", " que ", " dans "],
    "de": [" der ", " und ", " nicht ", " für ", " ist "],
    "es": [" el ", " los ", " para ", " por ", " una "],
}
LANGUAGE_LETTERS = {
    "en": ["th", "sh", "wh", "ly"],
    "fr": ["è", "ç", "eau", "ê"],
    "de": ["ü", "sch", "ß", "ung"],
    "es": ["ñ", "ó", "ción", "ía"],
}


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents", spread_by="doc_id")


def c1_clean_documents(spark, folder):
    return _docs(spark, folder).select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


def c1_clean_pages(spark, folder):
    pages = load(spark, folder, "pages", spread_by="page_id")
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("clean"))


def _marked(spark, folder):
    """Documents with a citation, a link and a bracketed name added from their own columns."""
    return _docs(spark, folder).withColumn("text", F.concat(
        F.lit("See (Citation: "), "source", F.lit(") and https://"), "lang", F.lit(".example.org/x?y=1 [["), "source",
        F.lit("]] —  «"), "text", F.lit("» (Citation: "), "lang",
    ))


MARKED = ("(SELECT doc_id, lang, source, 'See (Citation: ' || source || ') and https://' || lang || "
          "'.example.org/x?y=1 [[' || source || ']] —  «' || text || '» (Citation: ' || lang AS text "
          "FROM documents)")


def c3_c5_cleaning_steps(spark, folder):
    text = F.col("text")
    return _marked(spark, folder).select(
        "doc_id",
        F.length(tx.drop_citations(text)).alias("c3_chars"),
        F.length(tx.drop_urls(text)).alias("c4_chars"),
        F.length(tx.unwrap_links(text)).alias("c5_chars"),
        F.length(tx.keep_plain_characters(text)).alias("c6_chars"),
        F.md5(tx.keep_plain_characters(text).cast("binary")).alias("c6_digest"),
        F.length(tx.collapse_blanks(text)).alias("c7_chars"),
        F.md5(tx.clean_text(text).cast("binary")).alias("c1_digest"),
        F.md5(F.lower(tx.clean_text(text)).cast("binary")).alias("c8_digest"),
    )


def p5_previews(spark, folder):
    docs = load(spark, folder, "documents")
    text = F.col("text")
    return docs.select(
        "doc_id", tx.preview(text, fixed.DESCRIPTION_CHARS).alias("description"),
        tx.preview(text, fixed.PREVIEW_CHARS, "...").alias("preview"),
        tx.preview(text, fixed.ECHO_CHARS).alias("echo"),
        tx.clean_text(tx.preview(text, fixed.DETECTION_CHARS)).alias("cut_then_cleaned"),
    )


def f6_reject_blank(spark, folder):
    rows = load(spark, folder, "conversations").withColumn("blank", tx.is_blank(F.regexp_replace("text", r"[^.?!]", " ")))
    return rows.groupBy("role").agg(
        F.count_if(~F.col("blank")).alias("accepted"), F.count_if(F.col("blank")).alias("rejected")
    )


def x1_indicators(spark, folder):
    docs = _docs(spark, folder).select(F.concat(F.lit("d"), "doc_id").alias("key"), "text")
    pages = load(spark, folder, "pages", spread_by="page_id").select(
        F.concat(F.lit("p"), "page_id").alias("key"), F.concat_ws(" ", "url", "html").alias("text")
    )
    found = arrays.unnest(docs.unionByName(pages), tx.indicators(F.col("text")), "i", "key")
    return found.select("key", "i.kind", "i.value")


# RE2 refuses a bounded repetition of these groups; it does not recurse, so an unbounded one is safe there.
# The two differ only on domains of more than 126 labels, which DNS does not allow.
SQL_INDICATORS = {kind: p.replace("{1,126}", "+").replace("{0,126}", "*") for kind, p in tx.INDICATORS.items()}

X1_SQL = "WITH t AS (SELECT 'd' || doc_id AS key, text FROM documents UNION ALL " \
         "SELECT 'p' || page_id, url || ' ' || html FROM pages) " + " UNION ALL ".join(
             f"SELECT DISTINCT key, {q(kind)} AS kind, unnest(regexp_extract_all(text, {q(pattern)})) AS value FROM t"
             for kind, pattern in SQL_INDICATORS.items()
         )

# --- keyword scoring ---------------------------------------------------------

SCORER = keywords.KeywordScorer


def k1_keyword_hits(spark, folder):
    hits = arrays.unnest(_docs(spark, folder), SCORER().hits(F.col("text")), "h", "doc_id")
    return hits.select("doc_id", "h.label", "h.label_ord", "h.keyword")


def _scores(spark, folder, scorer):
    rows = arrays.unnest(_docs(spark, folder), scorer.scores(F.col("text")), "s", "doc_id")
    return rows.select("doc_id", "s.label", F.round("s.ratio", 6).alias("ratio"), F.round("s.score", 6).alias("score"))


def k2_k3_scores(spark, folder):
    return _scores(spark, folder, SCORER())


def k2_k3_language_scores(spark, folder):
    return _scores(spark, folder, SCORER(LANGUAGE_WORDS))


def k4_top_labels(spark, folder):
    docs = keywords.classify(_docs(spark, folder), "text", SCORER(), 3)
    return keywords.explode_ranked(docs, ["doc_id"])


def k4_conversation_labels(spark, folder):
    turns = keywords.classify(load(spark, folder, "conversations", spread_by="conv_id"), "text", SCORER(), 3)
    return keywords.explode_ranked(turns, ["conv_id", "turn"])


def k5_best_label(spark, folder):
    text = F.col("text")
    return _docs(spark, folder).select(
        "doc_id", "lang", SCORER().best(text).alias("best"), SCORER(LANGUAGE_WORDS).best(text).alias("best_language")
    )


def k6_plugged_scorer(spark, folder):
    """A scorer that is not a dictionary: share of characters before each of three marks."""
    def by_marks(text, top):
        return arrays.ranked(
            [(F.lit(mark), F.locate(mark, text) / F.greatest(F.length(text), F.lit(1))) for mark in (".", ",", "a")], top
        )

    return keywords.explode_ranked(keywords.classify(_docs(spark, folder), "text", by_marks, 2), ["doc_id"])


def _scores_sql(words: dict, table: str = "documents", keys: str = "doc_id") -> str:
    return f"""
r AS (SELECT {keys}, k.label, k.label_ord,
        sum(CASE WHEN contains(lower(text), k.keyword) THEN 1 ELSE 0 END) * 1.0 / greatest(count(*), 1) AS ratio
      FROM {table} CROSS JOIN {sql_keywords(words)} GROUP BY ALL),
s AS (SELECT *, ratio / coalesce(nullif(sum(ratio) OVER (PARTITION BY {keys}), 0), 1) AS score,
        row_number() OVER (PARTITION BY {keys} ORDER BY round(ratio, 12) DESC, label_ord) AS rank FROM r)"""


def _best_sql(words: dict, name: str) -> str:
    return f"SELECT doc_id, label AS {name} FROM (WITH {_scores_sql(words)} SELECT * FROM s WHERE rank = 1)"


# --- TF-IDF ------------------------------------------------------------------

def v1_tokens(spark, folder):
    rows = _docs(spark, folder).select("doc_id", tx.tokens(F.col("text")).alias("t"))
    return rows.select(
        "doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"),
        F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("first_token"),
    )


def v2_terms(spark, folder):
    rows = _docs(spark, folder).select("doc_id", tx.terms(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_terms"), F.size(F.array_distinct("t")).alias("n_distinct"))


def v3_term_frequency(spark, folder):
    return tfidf.term_frequency(_docs(spark, folder), "doc_id", "text")


def v4_vocabulary(spark, folder):
    return tfidf.vocabulary(_docs(spark, folder), "text", FEATURES)


def v5_document_frequency(spark, folder):
    return tfidf.document_frequency(_docs(spark, folder), "text")


def v6_v7_weights(spark, folder):
    docs = _docs(spark, folder)
    long = tfidf.fit(docs, "text", FEATURES).weights(docs, "doc_id", "text")
    return long.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def v8_transform_fitted(spark, folder):
    items = load(spark, folder, "benchmark")
    long = tfidf.fit(_docs(spark, folder), "text", FEATURES).weights(items, "item_id", "text")
    return long.select("item_id", "term", F.round("weight", 6).alias("weight"))


def v9_sparse_vectors(spark, folder):
    docs = _docs(spark, folder)
    model = tfidf.fit(docs, "text", FEATURES)
    rows = model.vectors(docs, "text").select("doc_id", F.unwrap_udt("features").alias("v"))
    return rows.select(
        "doc_id", F.col("v.size").alias("size"), F.size("v.indices").alias("entries"),
        F.round(F.aggregate("v.values", F.lit(0.0), lambda t, x: t + x), 6).alias("total"),
    )


def v10_v11_top_matches(spark, folder):
    docs, items = _docs(spark, folder), load(spark, folder, "benchmark")
    found = matching.top_matches(docs, "doc_id", items, "item_id", top=3)
    return found.select("doc_id", "rank", "item_id", "similarity")


def _fit_sql(key: str = "doc_id", features: int = FEATURES) -> str:
    """After ``terms``: ``vocab`` (term, idf) and the corpus size."""
    return f"""
tf AS (SELECT {key}, term, count(*) AS tf FROM terms GROUP BY ALL),
vocab AS (
  SELECT term, ln((1 + (SELECT count(*) FROM toks)) / (1.0 + count(*))) + 1 AS idf FROM tf
  WHERE term IN (SELECT term FROM terms GROUP BY term ORDER BY count(*) DESC, term LIMIT {features})
  GROUP BY term)"""


def _unit_sql(name: str, tf: str, key: str) -> str:
    return f"""
{name}_raw AS (SELECT {key}, term, (1 + ln(tf)) * idf AS w FROM {tf} JOIN vocab USING (term)),
{name} AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {name}_raw)"""


def weights_sql(features: int = FEATURES) -> str:
    """``unit`` (doc_id, term, weight) of all documents."""
    return f"WITH {sql_terms('documents', 'doc_id')}, {_fit_sql(features=features)}, {_unit_sql('unit', 'tf', 'doc_id')} "


WEIGHTS_SQL = weights_sql()

_ITEM_TERMS = sql_terms("benchmark", "item_id").replace("toks", "item_toks").replace("terms AS", "item_terms AS")

_BOTH = "(SELECT 'd' || doc_id AS key, text FROM documents UNION ALL SELECT 'i' || item_id, text FROM benchmark)"

QUERIES = {
    "c1_clean_documents": c1_clean_documents,
    "c1_clean_pages": c1_clean_pages,
    "c3_c8_cleaning_steps": c3_c5_cleaning_steps,
    "p5_previews": p5_previews,
    "f6_reject_blank": f6_reject_blank,
    "x1_indicators": x1_indicators,
    "k1_keyword_hits": k1_keyword_hits,
    "k2_k3_scores": k2_k3_scores,
    "k2_k3_language_scores": k2_k3_language_scores,
    "k4_top_labels": k4_top_labels,
    "k4_conversation_labels": k4_conversation_labels,
    "k5_best_label": k5_best_label,
    "k6_plugged_scorer": k6_plugged_scorer,
    "v1_tokens": v1_tokens,
    "v2_terms": v2_terms,
    "v3_term_frequency": v3_term_frequency,
    "v4_vocabulary": v4_vocabulary,
    "v5_document_frequency": v5_document_frequency,
    "v6_v7_weights": v6_v7_weights,
    "v8_transform_fitted": v8_transform_fitted,
    "v9_sparse_vectors": v9_sparse_vectors,
    "v10_v11_top_matches": v10_v11_top_matches,
}


def _step(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"


ORACLES = {
    "c1_clean_documents": f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents",
    "c1_clean_pages": f"SELECT page_id, {sql_clean('html')} AS clean FROM pages",
    "c3_c8_cleaning_steps": f"""
SELECT doc_id, length({_step('text', tx.CITATION, '')})::INT AS c3_chars, length({_step('text', tx.URL, '')})::INT AS c4_chars,
  length({_step('text', tx.WIKI_LINK, chr(92) + '1')})::INT AS c5_chars, length({_step('text', tx.UNWANTED, ' ')})::INT AS c6_chars,
  md5({_step('text', tx.UNWANTED, ' ')}) AS c6_digest, length(trim({_step('text', tx.BLANKS, ' ')}))::INT AS c7_chars,
  md5({sql_clean('text')}) AS c1_digest, md5(lower({sql_clean('text')})) AS c8_digest
FROM {MARKED}""",
    "p5_previews": f"""
SELECT doc_id, substring(text, 1, {fixed.DESCRIPTION_CHARS}) AS description,
  substring(text, 1, {fixed.PREVIEW_CHARS}) || '...' AS preview, substring(text, 1, {fixed.ECHO_CHARS}) AS echo,
  {sql_clean(f'substring(text, 1, {fixed.DETECTION_CHARS})')} AS cut_then_cleaned FROM documents""",
    "f6_reject_blank": f"""
SELECT role, count(*) FILTER (WHERE NOT blank) AS accepted, count(*) FILTER (WHERE blank) AS rejected
FROM (SELECT role, trim(regexp_replace(text, '[^.?!]', ' ', 'g')) = '' AS blank FROM conversations) GROUP BY role""",
    "x1_indicators": X1_SQL,
    "k1_keyword_hits": f"SELECT doc_id, k.label, k.label_ord, k.keyword FROM documents "
                       f"JOIN {sql_keywords(fixed.KEYWORDS)} ON contains(lower(text), k.keyword)",
    "k2_k3_scores": f"WITH {_scores_sql(fixed.KEYWORDS)} "
                    "SELECT doc_id, label, round(ratio, 6) AS ratio, round(score, 6) AS score FROM s",
    "k2_k3_language_scores": f"WITH {_scores_sql(LANGUAGE_WORDS)} "
                             "SELECT doc_id, label, round(ratio, 6) AS ratio, round(score, 6) AS score FROM s",
    "k4_top_labels": f"WITH {_scores_sql(fixed.KEYWORDS)} "
                     "SELECT doc_id, rank::INT AS rank, label, round(score, 4) AS score FROM s WHERE rank <= 3",
    "k4_conversation_labels": f"WITH {_scores_sql(fixed.KEYWORDS, 'conversations', 'conv_id, turn')} "
                              "SELECT conv_id, turn, rank::INT AS rank, label, round(score, 4) AS score FROM s WHERE rank <= 3",
    "k5_best_label": f"SELECT doc_id, lang, best, best_language FROM documents "
                     f"JOIN ({_best_sql(fixed.KEYWORDS, 'best')}) USING (doc_id) "
                     f"JOIN ({_best_sql(LANGUAGE_WORDS, 'best_language')}) USING (doc_id)",
    "k6_plugged_scorer": """
WITH s AS (SELECT doc_id, label, o, strpos(text, label) * 1.0 / greatest(length(text), 1) AS score
  FROM documents CROSS JOIN (VALUES ('.', 0), (',', 1), ('a', 2)) AS m(label, o))
SELECT doc_id, rank::INT AS rank, label, round(score, 4) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, o) AS rank FROM s) WHERE rank <= 2""",
    "v1_tokens": f"WITH {sql_terms('documents', 'doc_id')} SELECT doc_id, len(t)::INT AS n_tokens, "
                 "len(list_distinct(t))::INT AS n_distinct, coalesce(t[1], '') AS first_token FROM toks",
    "v2_terms": f"WITH {sql_terms('documents', 'doc_id')} SELECT doc_id, count(term)::INT AS n_terms, "
                "count(DISTINCT term)::INT AS n_distinct FROM toks LEFT JOIN terms USING (doc_id) GROUP BY doc_id",
    "v3_term_frequency": f"WITH {sql_terms('documents', 'doc_id')} "
                         "SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL",
    "v4_vocabulary": f"WITH {sql_terms('documents', 'doc_id')} "
                     f"SELECT term, count(*) AS n FROM terms GROUP BY term ORDER BY n DESC, term LIMIT {FEATURES}",
    "v5_document_frequency": f"WITH {sql_terms('documents', 'doc_id')} "
                             "SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term",
    "v6_v7_weights": WEIGHTS_SQL + "SELECT doc_id, term, round(weight, 6) AS weight FROM unit",
    "v8_transform_fitted": f"""
WITH {sql_terms('documents', 'doc_id')}, {_fit_sql()}, {_ITEM_TERMS},
item_tf AS (SELECT item_id, term, count(*) AS tf FROM item_terms GROUP BY ALL), {_unit_sql('unit', 'item_tf', 'item_id')}
SELECT item_id, term, round(weight, 6) AS weight FROM unit""",
    "v9_sparse_vectors": WEIGHTS_SQL + f"""
SELECT doc_id, (SELECT count(*) FROM vocab)::INT AS size, count(term)::INT AS entries,
  round(coalesce(sum(weight), 0), 6) AS total FROM documents LEFT JOIN unit USING (doc_id) GROUP BY doc_id""",
    "v10_v11_top_matches": f"""
WITH {sql_terms(_BOTH, 'key')},
tf AS (SELECT key, term, count(*) AS tf FROM terms GROUP BY ALL),
vocab AS (SELECT term, ln((1 + (SELECT count(*) FROM toks)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY term),
{_unit_sql('unit', 'tf', 'key')},
sims AS (SELECT substr(d.key, 2)::BIGINT AS doc_id, substr(i.key, 2)::BIGINT AS item_id,
    round(sum(d.weight * i.weight), 6) AS similarity
  FROM unit d JOIN unit i ON d.term = i.term AND d.key LIKE 'd%' AND i.key LIKE 'i%' GROUP BY ALL)
SELECT doc_id, rank::INT AS rank, item_id, similarity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) AS rank FROM sims
      WHERE similarity > 0) WHERE rank <= 3""",
}
