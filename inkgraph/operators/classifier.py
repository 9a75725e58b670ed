"""TF-IDF with multinomial logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.operators import tfidf

MIN_ROWS = 10
ROWS_PER_TASK = 5_000      # small training sets use fewer tasks per iteration


def enough_rows(df: DataFrame, more_than: int = MIN_ROWS) -> bool:
    """Training gate; reads no further than it has to."""
    return df.limit(more_than + 1).count() > more_than


def label_index(df: DataFrame, label: str, column: str = "label_idx") -> DataFrame:
    """Number the classes in alphabetical order."""
    return StringIndexer(inputCol=label, outputCol=column, stringOrderType="alphabetAsc").fit(df).transform(df)


@dataclass(frozen=True)
class TextClassifier:
    features: tfidf.TfIdf
    labels: list[str]
    model: LogisticRegressionModel

    def _scored(self, df: DataFrame, text: str) -> DataFrame:
        return self.model.transform(self.features.vectors(df, text, "features"))

    def predict(self, df: DataFrame, text: str, column: str = "predicted") -> DataFrame:
        named = IndexToString(inputCol="prediction", outputCol=column, labels=self.labels)
        return named.transform(self._scored(df, text)).select(*df.columns, column)

    def rank(self, df: DataFrame, text: str, top: int = 3, column: str = "ranked") -> DataFrame:
        """Add the ``top`` most probable labels as ``array<struct<label, score>>``."""
        return self._scored(df, text).withColumn(column, self._ranking(top)).select(*df.columns, column)

    def _ranking(self, top: int) -> Column:
        names = F.array(*map(F.lit, self.labels))
        keyed = F.transform(vector_to_array("probability"), lambda p, i: F.struct((-p).alias("key"), i.alias("i")))
        return F.transform(F.slice(F.array_sort(keyed), 1, top), lambda e: F.struct(
            F.get(names, e["i"]).alias("label"), F.round(-e["key"], 4).alias("score")
        ))


def fit(
    df: DataFrame, text: str, label: str, max_features: int = 15_000, c: float = 5.0, max_iter: int = 1000
) -> TextClassifier:
    """Train on labelled texts.

    The loss is ``C * sum(loss) + |w|^2 / 2``; divided by ``C * n`` it is Spark's
    mean loss with ``regParam = 1 / (C * n)``.
    """
    features = tfidf.fit(df, text, max_features)
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc").fit(df)
    rows = indexer.transform(features.vectors(df, text, "features")).select("features", "label_idx").persist()
    tasks = -(-rows.count() // ROWS_PER_TASK)
    try:
        model = LogisticRegression(
            featuresCol="features", labelCol="label_idx", maxIter=max_iter, elasticNetParam=0.0,
            regParam=1.0 / (c * features.n_docs), standardization=False,
        ).fit(rows.coalesce(tasks) if tasks < rows.rdd.getNumPartitions() else rows)
    finally:
        rows.unpersist()
    return TextClassifier(features, indexer.labels, model)
