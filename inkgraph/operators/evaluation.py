"""Metrics of one or more classifiers over the same rows.

Everything after ``confusion`` works on at most classes x classes rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def confusion(df: DataFrame, truth: str, predictions: dict[str, str]) -> DataFrame:
    """(model, y, yhat, n): one pass over the rows for all models."""
    answers = F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.col(column).cast("string").alias("yhat"))
        for model, column in predictions.items()
    ]))
    return (
        df.select(F.col(truth).cast("string").alias("y"), answers.alias("a"))
        .groupBy("a.model", "y", "a.yhat").agg(F.count("*").alias("n"))
    )


def accuracy(counts: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0))
    return counts.groupBy("model").agg(
        (right / F.sum("n")).alias("accuracy"), F.sum("n").alias("support")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each label seen as truth or as prediction."""
    sides = F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("true"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("yhat").alias("label"), F.lit(0).cast("long").alias("true"), F.col("n").alias("said")),
    ))
    hit = F.when((F.col("y") == F.col("yhat")) & (F.col("s.true") > 0), F.col("n")).otherwise(0)
    sums = (
        counts.select("model", "y", "yhat", "n", sides.alias("s"))
        .groupBy("model", "s.label")
        .agg(F.sum(hit).alias("tp"), F.sum("s.said").alias("said"), F.sum("s.true").alias("support"))
    )
    rated = sums.withColumns({
        "precision": _ratio(F.col("tp"), F.col("said")), "recall": _ratio(F.col("tp"), F.col("support")),
    })
    both = F.col("precision") + F.col("recall")
    return rated.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both)).select(
        "model", "label", "precision", "recall", "f1", "support"
    )


def averages(report: DataFrame) -> DataFrame:
    """The ``macro avg`` and ``weighted avg`` rows of a class report."""
    measures = ["precision", "recall", "f1"]
    weighted = [_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"w_{m}") for m in measures]
    sums = report.groupBy("model").agg(*[F.avg(m).alias(m) for m in measures], *weighted, F.sum("support").alias("n"))
    rows = F.explode(F.array(
        F.struct(F.lit("macro avg").alias("label"), *measures),
        F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"w_{m}").alias(m) for m in measures]),
    ))
    return sums.select("model", rows.alias("r"), F.col("n").alias("support")).select(
        "model", "r.label", "r.precision", "r.recall", "r.f1", "support"
    )


def full_report(counts: DataFrame) -> DataFrame:
    """Per-class rows, averages, and accuracy (in the precision, recall and f1 columns)."""
    report = class_report(counts)
    overall = accuracy(counts).select(
        "model", F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"),
        F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), "support",
    )
    return report.unionByName(averages(report)).unionByName(overall)


def compare(df: DataFrame, truth: str, predictions: dict[str, str]) -> DataFrame:
    """The full report of several prediction columns on the same hold-out."""
    return full_report(confusion(df, truth, predictions))
