"""What the two vector searches share: valid rows, blocks that meet in pairs, and the merge of their best lists."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATE_BLOCK = 16_384     # rows of a block, in expectation
QUERY_BLOCK = 4_096


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, v: array<double>) of rows with an id and a vector without null or non-finite components; equal rows once."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).dropDuplicates(["vec_id", "v"])


def lengths(rows: DataFrame) -> list[int]:
    """The vector lengths that occur; vectors of different lengths are never compared."""
    return sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), width)


def block(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int")


def search(rows: DataFrame, queries: Column, best: Callable, top: int, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` rows of highest score for each query.

    Every block of candidates meets every block of queries in one task, where
    ``best(query ids, queries, candidate ids, candidates)`` gives the best pairs
    as (query row, candidate id, score).  Rows are copied once per block of the
    other side, so nothing is broadcast and no task holds more than two blocks.
    """
    n, n_queries = rows.count(), rows.filter(queries).count()
    n_c, n_q = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = rows.select("vec_id", "v", block(n_c).alias("c"), every(n_q).alias("q"))
    right = rows.filter(queries).select("vec_id", "v", every(n_c).alias("c"), block(n_q).alias("q"))
    def meet(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(candidates) or not len(asked):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.type_for_alias(score))})
        width = len(candidates["v"][0])
        ids = asked["vec_id"].to_numpy()
        query, found, value = best(ids, matrix(asked["v"], width), candidates["vec_id"].to_numpy(), matrix(candidates["v"], width))
        return pa.table({"query_id": pa.array(ids[query]), "vec_id": pa.array(found), "score": pa.array(value, pa.type_for_alias(score))})

    kind = {"int64": "long", "double": "double"}[score]
    met = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(meet, f"query_id long, vec_id long, score {kind}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def keep_best(query: np.ndarray, found: np.ndarray, value: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` entries of each query, by falling score and then id, with their rank."""
    order = np.lexsort((found, -value, query))
    query, found, value = query[order], found[order], value[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    keep = rank < top
    return query[keep], found[keep], value[keep], rank[keep]
