"""TF-IDF over single words and pairs of neighbouring words.

Fitting looks at the texts once and shuffles one row per distinct term and
batch of texts.  Transforming shuffles nothing: the vocabulary is bounded by
``max_features`` and each document becomes a sparse row in place.  Both work on
whole batches of tokens as numbers (``term_batches``).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkgraph.functions.arrays import unnest
from inkgraph.functions.text import terms, tokens
from inkgraph.operators import term_batches


def document_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per term occurrence."""
    return docs.select(key, F.explode(terms(F.col(text))).alias("term"))


def term_frequency(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Texts are exchanged by key, not their terms one by one: those of a key then meet in one place and are counted there."""
    return document_terms(docs.select(key, text).repartition(key), key, text).groupBy(key, "term").agg(F.count("*").alias("tf"))


def term_counts(docs: DataFrame, text: str) -> DataFrame:
    """(term, n, df): how often each term occurs in the corpus and in how many rows; each task adds up whole batches first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in term_batches.slices(batch.column(0)):
                yield term_batches.count(some)

    counted = docs.select(tokens(F.col(text)).alias("tokens")).mapInArrow(run, "term string, n long, df long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def corpus_counts(docs: DataFrame, text: str) -> DataFrame:
    """How often each term occurs in the whole corpus."""
    return term_counts(docs, text).select("term", "n")


def document_frequency(docs: DataFrame, text: str) -> DataFrame:
    """In how many documents each term occurs; repeats are dropped inside the row."""
    return term_counts(docs, text).select("term", "df")


def vocabulary(docs: DataFrame, text: str, max_features: int) -> DataFrame:
    """The ``max_features`` most frequent terms, alphabetical among equal counts."""
    return _most_frequent(corpus_counts(docs, text), max_features)


def _most_frequent(counts: DataFrame, max_features: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(max_features)


@dataclass(frozen=True)
class TfIdf:
    """A fitted vocabulary: terms in index order, their document counts, corpus size."""

    terms: list[str]
    df: list[int]
    n_docs: int

    @property
    def size(self) -> int:
        return len(self.terms)

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + df)) + 1 for df in self.df]

    def table(self, spark: SparkSession) -> DataFrame:
        schema = "idx int, term string, df long, idf double"
        return spark.createDataFrame(
            [(i, *row) for i, row in enumerate(zip(self.terms, self.df, self.idf))], schema
        )

    def transform(self, docs: DataFrame, text: str) -> DataFrame:
        """Add ``indices`` and ``weights``: the unit-length sparse row of each document."""
        row = "inkgraph_row"
        return (
            docs.withColumn(row, self._rows(docs.sparkSession, T.StructType.fromDDL("indices array<int>, weights array<double>"))(tokens(F.col(text))))
            .withColumns({"indices": F.col(f"{row}.indices"), "weights": F.col(f"{row}.weights")})
            .drop(row)
        )

    def _rows(self, spark: SparkSession, kind: T.DataType):
        """A function from tokens to sparse rows, as two arrays or as an ML vector; a batch of texts at a time."""
        shared = spark.sparkContext.broadcast((term_batches.Vocabulary(self.terms), np.array(self.idf, float)))
        size, as_vector = self.size, isinstance(kind, VectorUDT)

        def rows(lists: pa.Array) -> pa.Array:
            made = [_sparse_rows(some, *shared.value, size if as_vector else None) for some in term_batches.slices(lists)]
            return pa.concat_arrays(made) if made else _sparse_rows(lists, *shared.value, size if as_vector else None)

        return F.arrow_udf(rows, kind)

    def vectors(self, docs: DataFrame, text: str, column: str = "features") -> DataFrame:
        """``docs`` with the sparse row of ``transform`` as an ML vector."""
        return docs.withColumn(column, self._rows(docs.sparkSession, VectorUDT())(tokens(F.col(text))))

    def weights(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """Long form: key, term, weight."""
        return explode_weights(self.transform(docs, text), key, self)


def _sparse_rows(lists: pa.Array, vocabulary: term_batches.Vocabulary, idf: np.ndarray, size: int | None) -> pa.StructArray:
    """(indices, weights) of each token list, unit length; with ``size`` as the storage of a sparse ML vector."""
    row, term, tf = vocabulary.counts(lists)
    raw = (1 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(row, raw * raw, len(lists)))[row]
    weights = np.where(norm > 0, raw / np.where(norm > 0, norm, 1.0), raw)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]), pa.int32())
    columns = {
        "indices": pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
        "weights": pa.ListArray.from_arrays(ends, pa.array(weights, pa.float64())),
    }
    if size is not None:
        columns = {"type": pa.array(np.zeros(len(lists)), pa.int8()), "size": pa.array(np.full(len(lists), size), pa.int32()),
                   "indices": columns["indices"], "values": columns["weights"]}
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def fit(docs: DataFrame, text: str, max_features: int) -> TfIdf:
    """Learn vocabulary and document counts in one look at the texts; only ``max_features`` rows reach the driver."""
    kept = {row["term"]: row["df"] for row in _most_frequent(term_counts(docs, text), max_features).collect()}
    if not kept:
        raise ValueError("no terms: every document is empty")
    terms = sorted(kept)
    return TfIdf(terms, [kept[term] for term in terms], docs.count())


def explode_weights(rows: DataFrame, key: str, model: TfIdf) -> DataFrame:
    """Sparse rows to (key, term, weight)."""
    names = F.from_json(F.lit(json.dumps(model.terms)), T.ArrayType(T.StringType()))
    return unnest(rows, F.arrays_zip("indices", "weights"), "e", key).select(
        key, F.get(names, F.col("e.indices")).alias("term"), F.col("e.weights").alias("weight")
    )
