"""Classifying and clustering collections of reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from inkgraph import fixed_values as fixed
from inkgraph import schemas
from inkgraph.functions.text import preview
from inkgraph.operators import classifier, clustering, evaluation, hierarchy, lsa, profiles, silhouette, split
from inkgraph.operators.keywords import KeywordScorer, Scorer
from inkgraph.session import cut


@dataclass(frozen=True)
class Evaluation:
    report: DataFrame                     # model, label, precision, recall, f1, support
    classifier: classifier.TextClassifier


def evaluate_classifiers(
    labelled: DataFrame, key: str, text: str, label: str, scorer: KeywordScorer | None = None,
    max_features: int = 15_000, test_share: float = 0.2, seed: int = 42,
) -> Evaluation:
    """Train on four fifths and compare with keyword scoring on the rest."""
    rows = cut(split.stratified_split(labelled.select(key, text, label), key, label, test_share, seed))
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    trained = classifier.fit(train, text, label, max_features)
    scorer = KeywordScorer() if scorer is None else scorer
    answers = trained.predict(test, text, "supervised").withColumn("zero_shot", scorer.best(F.col(text)))
    counts = cut(evaluation.confusion(answers, label, {"supervised": "supervised", "zero_shot": "zero_shot"}))
    return Evaluation(evaluation.full_report(counts), trained)


def train_if_enough(labelled: DataFrame, text: str, label: str, **options) -> classifier.TextClassifier | None:
    """A trained classifier, or none if there are too few rows."""
    return classifier.fit(labelled, text, label, **options) if classifier.enough_rows(labelled) else None


def classify_reports(
    reports: DataFrame, key: str, title: str, text: str, model: classifier.TextClassifier | None = None,
    scorer: Scorer | None = None, top: int = 3,
) -> DataFrame:
    """(report_id, title, text_preview, supervised, zero_shot); no shuffle, ``supervised`` empty without a model."""
    rows = reports.select(F.col(key).alias("report_id"), F.col(title).alias("title"), F.col(text).alias("text"))
    rows = rows.withColumn("zero_shot", (scorer or KeywordScorer())(F.col("text"), top))
    if model is None:
        rows = rows.withColumn("supervised", F.array().cast(schemas.RANKED))
    else:
        rows = model.rank(rows, "text", top, "supervised")
    return rows.select(
        "report_id", "title", preview(F.col("text"), fixed.PREVIEW_CHARS, "...").alias("text_preview"),
        "supervised", "zero_shot",
    )


@dataclass(frozen=True)
class Clusters:
    profiles: DataFrame
    scatter: DataFrame
    keywords: DataFrame
    km_silhouette: float
    hac_silhouette: float


def cluster_reports(
    reports: DataFrame, key: str, title: str, text: str, names: DataFrame, k: int = 4, n_components: int = 50,
    max_features: int = 10_000, restarts: int = clustering.RESTARTS, hierarchy_method: str = "bisecting",
    measure: str = "squared",
) -> Clusters:
    """Embed, cluster twice, project, and describe each cluster by its keywords.

    Every step is linear in the number of reports, unless ``hierarchy_method='ward'``
    or ``measure='euclidean'`` ask for all pairs.
    """
    model = lsa.fit(reports, text, n_components, max_features)
    dense = cut(model.transform(reports.select(key, title, text), text))
    km = clustering.kmeans(dense, "embedding", k, restarts).assigned
    if hierarchy_method == "ward":
        hac = hierarchy.ward(dense, key, "embedding", k)
    else:
        hac = clustering.bisecting(dense, "embedding", k)
    km, hac = cut(km), cut(hac)
    sparse = model.features.transform(km.select(key, text, "cluster"), text)
    keywords = cut(clustering.cluster_keywords(sparse, "cluster", model.features))
    points = lsa.project_2d(km, "embedding")
    return Clusters(
        profiles.profiles(reports, key, title, km, hac, names, clustering.keyword_lists(keywords)),
        profiles.scatter(points, key, title, names),
        keywords,
        round(silhouette.score(km, key, "embedding", "cluster", measure), 4),
        round(silhouette.score(hac, key, "embedding", "cluster", measure), 4),
    )
