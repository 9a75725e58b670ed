"""Dense document rows: truncated SVD of TF-IDF, and a 2-D projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F, types as T

from inkgraph.operators import tfidf


@dataclass(frozen=True)
class Lsa:
    """Vocabulary, singular values and right singular vectors (terms x components).

    The size of ``components`` is bounded by the two parameters of the fit, not
    by the corpus.
    """

    features: tfidf.TfIdf
    singular_values: list[float]
    components: np.ndarray

    def transform(self, docs: DataFrame, text: str, column: str = "embedding") -> DataFrame:
        """Add the unit-length dense row of each document; no shuffle."""
        sparse = self.features.transform(docs, text)
        schema = T.StructType(docs.schema.fields + [T.StructField(column, T.ArrayType(T.DoubleType()))])
        shared = docs.sparkSession.sparkContext.broadcast(self.components)

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                dense = [np.asarray(w, float) @ shared.value[np.asarray(i, np.int64)]
                         for i, w in zip(batch["indices"], batch["weights"])]
                batch[column] = [row / (np.linalg.norm(row) or 1.0) for row in dense]
                yield batch.drop(columns=["indices", "weights"])

        return sparse.mapInPandas(project, schema)


def fit(docs: DataFrame, text: str, n_components: int = 50, max_features: int = 10_000) -> Lsa:
    """Uncentred truncated SVD; singular vectors are found without forming a Gram matrix on one machine."""
    features = tfidf.fit(docs, text, max_features)
    k = min(n_components, features.size - 1, features.n_docs)
    rows = MLUtils.convertVectorColumnsFromML(
        features.vectors(docs, text, "features").select("features"), "features"
    ).persist()
    try:
        svd = RowMatrix(rows, features.n_docs, features.size).computeSVD(k)
        return Lsa(features, svd.s.toArray().tolist(), svd.V.toArray())
    finally:
        rows.unpersist()


def embed(
    docs: DataFrame, text: str, n_components: int = 50, max_features: int = 10_000, column: str = "embedding"
) -> DataFrame:
    return fit(docs, text, n_components, max_features).transform(docs, text, column)


def project_2d(df: DataFrame, column: str) -> DataFrame:
    """Add ``x`` and ``y``: the first two principal components of a centred array column."""
    vectors = df.withColumn("pca_raw", array_to_vector(F.col(column).cast("array<double>")))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="pca_raw", outputCol="pca_in")
    rows = centred.fit(vectors).transform(vectors)
    out = PCA(k=2, inputCol="pca_in", outputCol="pca_out").fit(rows).transform(rows)
    point = vector_to_array("pca_out")
    return out.withColumns({"x": point[0], "y": point[1]}).drop("pca_raw", "pca_in", "pca_out")
