"""Splitting, training, predicting and measuring on the document labels and languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.catalog.bundles import labelled_techniques
from inkgraph.catalog.common import load
from inkgraph.catalog.texts import LANGUAGE_LETTERS, LANGUAGE_WORDS, _scores_sql
from inkgraph.operators import classifier, evaluation, keywords, split
from inkgraph.plans import reports

FEATURES = 15_000


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents", spread_by="doc_id")


def _labelled(spark, folder):
    rated = load(spark, folder, "labels").withColumn("quality", F.col("quality").cast("string"))
    return _docs(spark, folder).select("doc_id", "lang").join(rated, "doc_id")


def m1_label_index(spark, folder):
    rows = classifier.label_index(_docs(spark, folder).select("doc_id", "lang"), "lang")
    return rows.select("doc_id", "lang", F.col("label_idx").cast("int").alias("label_idx"))


def f7_training_gate(spark, folder):
    kinds = _labelled(spark, folder).groupBy("quality").agg(F.count("*").alias("n"))
    enough = classifier.enough_rows(_labelled(spark, folder))
    return kinds.withColumn("enough", F.lit(enough))


def m5_split_quality(spark, folder):
    return split.stratified_split(_labelled(spark, folder), "doc_id", "quality").select("doc_id", "quality", "is_test")


def m5_split_language(spark, folder):
    return split.stratified_split(_docs(spark, folder).select("doc_id", "lang"), "doc_id", "lang")


def _predicted(spark, folder):
    """Two dictionary classifiers for the language of each document."""
    text = F.col("text")
    return _docs(spark, folder).select(
        "doc_id", "lang", keywords.KeywordScorer(LANGUAGE_WORDS).best(text).alias("by_words"),
        keywords.KeywordScorer(LANGUAGE_LETTERS).best(text).alias("by_letters"),
    )


MODELS = {"words": "by_words", "letters": "by_letters"}


def _confusion(spark, folder):
    return evaluation.confusion(_predicted(spark, folder), "lang", MODELS)


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


def m6_accuracy(spark, folder):
    return _rounded(evaluation.accuracy(_confusion(spark, folder)), "accuracy")


def m7_confusion(spark, folder):
    return _confusion(spark, folder)


def m8_class_report(spark, folder):
    return _rounded(evaluation.class_report(_confusion(spark, folder)), "precision", "recall", "f1")


def m9_averages(spark, folder):
    report = evaluation.class_report(_confusion(spark, folder))
    return _rounded(evaluation.averages(report), "precision", "recall", "f1")


def m10_compare_on_holdout(spark, folder):
    """Both dictionaries on the held-out fifth."""
    held = split.stratified_split(_predicted(spark, folder), "doc_id", "lang").filter("is_test")
    return _rounded(evaluation.compare(held, "lang", MODELS), "precision", "recall", "f1")


def m10_trained_against_keywords(spark, folder):
    """Logistic regression and dictionary on the same hold-out."""
    rows = _docs(spark, folder).select("doc_id", "text", "lang")
    result = reports.evaluate_classifiers(
        rows, "doc_id", "text", "lang", keywords.KeywordScorer(LANGUAGE_WORDS), max_features=FEATURES
    )
    return _rounded(result.report, "precision", "recall", "f1")


def m10_techniques(spark, folder):
    """Bundles to measures: techniques un-nested, cleaned and labelled, split, trained on and compared with the keywords."""
    result = reports.evaluate_classifiers(
        labelled_techniques(spark, folder), "stix_id", "text_for_nlp", "primary_tactic", max_features=FEATURES
    )
    return _rounded(result.report, "precision", "recall", "f1")


def m2_m3_predictions(spark, folder):
    docs = _docs(spark, folder)
    rows = docs.join(load(spark, folder, "labels"), "doc_id").withColumn("quality", F.col("quality").cast("string"))
    model = classifier.fit(rows, "text", "quality", FEATURES)
    return model.predict(docs, "text").select("doc_id", "predicted")


def m4_top_probabilities(spark, folder):
    docs = _docs(spark, folder)
    model = classifier.fit(docs, "text", "lang", FEATURES)
    return keywords.explode_ranked(model.rank(docs, "text", 3), ["doc_id"])


def m11_classified_reports(spark, folder):
    docs = _docs(spark, folder)
    model = classifier.fit(docs, "text", "lang", FEATURES)
    rows = reports.classify_reports(docs, "doc_id", "source", "text", model)
    return rows.select(
        "report_id", "title", "text_preview",
        F.array_join(F.transform("supervised", lambda e: e["label"]), ", ").alias("supervised"),
        F.array_join(F.transform("zero_shot", lambda e: e["label"]), ", ").alias("zero_shot"),
    )


def m11_reports_without_model(spark, folder):
    rows = reports.classify_reports(_docs(spark, folder), "doc_id", "source", "text", None)
    return rows.select(
        "report_id", "title", "text_preview", F.size("supervised").alias("n_supervised"),
        F.array_join(F.transform("zero_shot", lambda e: e["label"]), ", ").alias("zero_shot"),
    )


def _split_sql(rows: str, label: str) -> str:
    return f"""
sizes AS (SELECT {label}, count(*) AS n, sum(count(*)) OVER () AS n_all FROM {rows} GROUP BY {label}),
parts AS (SELECT *, (n_all - ceil(round(0.2 * n_all, 9)))::BIGINT AS n_train FROM sizes),
wanted AS (SELECT {label}, n - (n * n_train // n_all) - (CASE WHEN
    row_number() OVER (ORDER BY n * n_train % n_all DESC, {label}) <= n_train - sum(n * n_train // n_all) OVER ()
    THEN 1 ELSE 0 END) AS n_test FROM parts),
held AS (SELECT r.*, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || doc_id), doc_id) <= n_test AS is_test
  FROM {rows} r JOIN wanted USING ({label}))"""


_LABELLED = "(SELECT doc_id, lang, quality::VARCHAR AS quality FROM documents JOIN labels USING (doc_id))"


def _best(words, name):
    return f"SELECT doc_id, label AS {name} FROM (WITH {_scores_sql(words)} SELECT * FROM s WHERE rank = 1)"


_PREDICTED = f"""
answers AS (SELECT doc_id, lang, by_words, by_letters FROM documents JOIN ({_best(LANGUAGE_WORDS, 'by_words')}) USING (doc_id)
  JOIN ({_best(LANGUAGE_LETTERS, 'by_letters')}) USING (doc_id))"""


def _counts(rows: str) -> str:
    return f"""
counts AS (SELECT model, y, yhat, count(*) AS n FROM (
  SELECT 'words' AS model, lang AS y, by_words AS yhat FROM {rows} UNION ALL
  SELECT 'letters', lang, by_letters FROM {rows}) GROUP BY ALL),
accuracy AS (SELECT model, sum(CASE WHEN y = yhat THEN n ELSE 0 END) / sum(n) AS accuracy, sum(n)::BIGINT AS support
  FROM counts GROUP BY model),
names AS (SELECT model, y AS label FROM counts UNION SELECT model, yhat FROM counts),
sums AS (SELECT model, label, coalesce(sum(n) FILTER (WHERE y = label AND yhat = label), 0) AS tp,
    coalesce(sum(n) FILTER (WHERE yhat = label), 0) AS said, coalesce(sum(n) FILTER (WHERE y = label), 0) AS support
  FROM names JOIN counts USING (model) GROUP BY ALL),
rates AS (SELECT *, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM sums),
report AS (SELECT model, label, precision, recall,
    coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support::BIGINT AS support FROM rates),
means AS (
  SELECT model, 'macro avg' AS label, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1,
    sum(support)::BIGINT AS support FROM report GROUP BY model UNION ALL
  SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM report GROUP BY model)"""


_ROUND = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"

QUERIES = {
    "f7_training_gate": f7_training_gate,
    "m1_label_index": m1_label_index,
    "m5_split_quality": m5_split_quality,
    "m5_split_language": m5_split_language,
    "m6_accuracy": m6_accuracy,
    "m7_confusion": m7_confusion,
    "m8_class_report": m8_class_report,
    "m9_averages": m9_averages,
    "m10_compare_on_holdout": m10_compare_on_holdout,
    "m10_trained_against_keywords": m10_trained_against_keywords,
    "m10_techniques": m10_techniques,
    "m2_m3_predictions": m2_m3_predictions,
    "m4_top_probabilities": m4_top_probabilities,
    "m11_classified_reports": m11_classified_reports,
    "m11_reports_without_model": m11_reports_without_model,
}

ORACLES = {
    "f7_training_gate": f"SELECT quality, count(*) AS n, (SELECT count(*) > 10 FROM {_LABELLED}) AS enough "
                        f"FROM {_LABELLED} GROUP BY quality",
    "m1_label_index": "SELECT doc_id, lang, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS label_idx FROM documents",
    "m5_split_quality": f"WITH {_split_sql(_LABELLED, 'quality')} SELECT doc_id, quality, is_test FROM held",
    "m5_split_language": f"WITH {_split_sql('documents', 'lang')} SELECT doc_id, lang, is_test FROM held",
    "m6_accuracy": f"WITH {_PREDICTED}, {_counts('answers')} "
                   "SELECT model, round(accuracy, 6) AS accuracy, support FROM accuracy",
    "m7_confusion": f"WITH {_PREDICTED}, {_counts('answers')} SELECT model, y, yhat, n FROM counts",
    "m8_class_report": f"WITH {_PREDICTED}, {_counts('answers')} SELECT model, label, {_ROUND} FROM report",
    "m9_averages": f"WITH {_PREDICTED}, {_counts('answers')} SELECT model, label, {_ROUND} FROM means",
    "m10_compare_on_holdout": f"""
WITH {_PREDICTED}, {_split_sql('answers', 'lang')}, {_counts('(SELECT * FROM held WHERE is_test)')}
SELECT model, label, {_ROUND} FROM report UNION ALL SELECT model, label, {_ROUND} FROM means UNION ALL
SELECT model, 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), support FROM accuracy""",
    "m11_reports_without_model": f"""
WITH {_scores_sql(fixed.KEYWORDS)}
SELECT doc_id AS report_id, source AS title, substring(text, 1, 200) || '...' AS text_preview, 0 AS n_supervised, zero_shot
FROM documents JOIN (SELECT doc_id, string_agg(label, ', ' ORDER BY rank) AS zero_shot FROM s WHERE rank <= 3 GROUP BY doc_id)
  USING (doc_id)""",
}
