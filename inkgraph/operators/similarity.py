"""Best matches of each document in a reference collection, by cosine.

Rows are unit-length sparse rows over one vocabulary, so a cosine is a dot
product.  Each task multiplies a batch of documents with a block of references
and keeps the best ``top`` per document; (document, reference) pairs are never
written out.  A reference collection counted to be small goes to every task;
a larger one is cut into blocks that meet blocks of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ENTRIES = 5_000_000      # non-zero entries of one block of references
BLOCK_DOCS = 20_000

PLACES = 6                     # cosines are compared after rounding, then by reference id


class _Postings:
    """References of one block, grouped by term."""

    def __init__(self, refs: pd.DataFrame):
        refs = refs.sort_values("ref").reset_index(drop=True)
        self.ids = refs["ref"].to_numpy()
        sizes = refs["ref_indices"].map(len).to_numpy()
        rows = np.repeat(np.arange(len(refs)), sizes)
        terms = np.concatenate([*refs["ref_indices"], np.empty(0, np.int64)]).astype(np.int64)
        weights = np.concatenate([*refs["ref_weights"], np.empty(0)])
        order = np.argsort(terms, kind="stable")
        self.rows, self.weights = rows[order], weights[order]
        self.starts = np.searchsorted(terms[order], np.arange(terms.max(initial=-1) + 2))

    def best(self, indices: np.ndarray, weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        known = indices < len(self.starts) - 1
        indices, weights = indices[known], weights[known]
        first, last = self.starts[indices], self.starts[indices + 1]
        length = last - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        sums = np.bincount(self.rows[at], np.repeat(weights, length) * self.weights[at], len(self.ids))
        sums = np.round(sums, PLACES)
        hit = np.flatnonzero(sums > 0)
        hit = hit[np.lexsort((hit, -sums[hit]))[:top]]
        return self.ids[hit], sums[hit]


def _match(docs: pd.DataFrame, postings: _Postings, top: int) -> pd.DataFrame:
    found = [
        postings.best(np.asarray(i, np.int64), np.asarray(w, float), top)
        for i, w in zip(docs["indices"], docs["weights"])
    ]
    sizes = [len(ids) for ids, _ in found]
    return pd.DataFrame({
        "doc": np.repeat(docs["doc"].to_numpy(), sizes),
        "rank": np.concatenate([np.arange(1, size + 1) for size in sizes] or [np.empty(0, np.int64)]),
        "ref": np.concatenate([ids for ids, _ in found] or [np.empty(0, np.int64)]),
        "similarity": np.concatenate([sims for _, sims in found] or [np.empty(0)]),
    })


def top_matches(
    docs: DataFrame, doc: str, refs: DataFrame, ref: str, top: int = 3, block_entries: int = BLOCK_ENTRIES,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """(doc, rank, ref, similarity) from two frames with ``indices`` and ``weights``."""
    left = docs.select(F.col(doc).alias("doc"), "indices", "weights")
    right = refs.select(
        F.col(ref).alias("ref"), F.col("indices").alias("ref_indices"), F.col("weights").alias("ref_weights")
    )
    schema = f"doc {left.schema['doc'].dataType.simpleString()}, rank int, " \
             f"ref {right.schema['ref'].dataType.simpleString()}, similarity double"
    right = right.filter(F.size("ref_indices") > 0)
    entries = right.agg(F.sum(F.size("ref_indices"))).first()[0] or 0
    blocks = max(1, math.ceil(entries / block_entries))
    if blocks == 1:      # rows and entries are both within the checked bound
        shared = docs.sparkSession.sparkContext.broadcast(_Postings(right.toPandas()))

        def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield _match(batch, shared.value, top)

        return left.mapInPandas(match, schema).select(
            F.col("doc").alias(doc), "rank", F.col("ref").alias(ref), "similarity"
        )
    best = _matched_by_blocks(left, right, schema, top, blocks, block_docs)
    order = Window.partitionBy("doc").orderBy(F.desc("similarity"), "ref")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("doc").alias(doc), "rank", F.col("ref").alias(ref), "similarity")


def _matched_by_blocks(left, right, schema, top, blocks, block_docs) -> DataFrame:
    """Every block of documents meets every block of references in one task each."""
    doc_blocks = max(1, math.ceil(left.count() / block_docs))

    def cells(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>"))
        )

    grid_docs = cells(left, "doc", "db", doc_blocks, "rb", blocks)
    grid_refs = cells(right, "ref", "rb", blocks, "db", doc_blocks)

    def match(docs: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        if not len(docs) or not len(refs):
            docs = docs.iloc[:0]
        return _match(docs, _Postings(refs), top)

    return grid_docs.groupBy("db", "rb").cogroup(grid_refs.groupBy("db", "rb")).applyInPandas(match, schema)
