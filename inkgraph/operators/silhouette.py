"""Silhouette of a clustering.

``euclidean`` is the exact measure with true distances; it has to look at every
pair of rows, so its work grows with the square of the rows.  Rows are put into
blocks and two blocks meet in one task, which returns only a sum per row and
cluster; there are as many blocks as keep the cores busy, so what is shuffled
grows with the rows.  ``squared`` uses squared distances, for which sums per cluster are
enough: one pass, the choice for large data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from inkgraph.operators.skew import lookup_join
from inkgraph.session import cut

BLOCK_ROWS = 2_000          # rows of a block, unless blocks of that size would be more than the cores need
LARGEST_BYTES = 64_000_000  # of one block's vectors; a task holds two blocks and one table of BLOCK_ROWS x BLOCK_ROWS
PAIRS_PER_CORE = 8


def block_count(df: DataFrame, rows: int, block_rows: int, dim: int = 64) -> int:
    """Blocks such that pairs of them keep all cores busy; more only if a block's vectors would not fit.

    A row is copied once per block, so blocks of a fixed size would make copies grow
    with the square of the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    enough = math.ceil(math.sqrt(2 * PAIRS_PER_CORE * cores))
    return max(1, min(math.ceil(rows / block_rows), enough), math.ceil(rows * dim * 8 / LARGEST_BYTES))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float)


def block_pairs(df: DataFrame, key: str, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of all unordered block pairs (a <= b), with columns ``a`` and ``b``.

    A row is copied once per block, never once per other row.
    """
    own = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    rows = df.withColumn("own", own)
    last = F.lit(blocks - 1)
    left = rows.withColumn("b", F.explode(F.sequence(F.col("own"), last))).withColumnRenamed("own", "a")
    right = rows.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("own")))).withColumnRenamed("own", "b")
    return left, right


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(squares, 0.0))


def _sums(keys, own, totals: np.ndarray, names: np.ndarray) -> pd.DataFrame:
    """Rows of summed distances to each cluster present on the other side."""
    return pd.DataFrame({
        "id": np.repeat(keys, len(names)), "own": np.repeat(own, len(names)),
        "other": np.tile(names, len(keys)), "total": totals.ravel(),
    })


def _members(clusters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, codes = np.unique(clusters, return_inverse=True)
    member = np.zeros((len(codes), len(names)))
    member[np.arange(len(codes)), codes] = 1.0
    return names, member


def distance_sums(df: DataFrame, key: str, column: str, cluster: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, own, other, total): summed distance of each row to all rows of each cluster."""
    return distance_sums_many(df, key, column, [cluster], block_rows).drop("which")


def distance_sums_many(df: DataFrame, key: str, column: str, clusters: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``distance_sums`` of several clusterings of the same rows from one look at all pairs; ``which`` is its number."""
    vector = F.col(column) if df.schema[column].dataType.simpleString() == "array<float>" else F.col(column).cast("array<double>")
    names = [f"cluster{i}" for i in range(len(clusters))]
    rows = df.select(F.col(key).alias("id"), vector.alias("v"), *[F.col(c).alias(n) for c, n in zip(clusters, names)])
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    left, right = block_pairs(rows, "id", block_count(df, n, block_rows, max(dim or 1, 1)))
    kind = {name: rows.schema[name].dataType.simpleString() for name in ("id", names[0])}

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"which": [], "id": [], "own": [], "other": [], "total": []})
        x, y, xs, ys = matrix(a["v"]), matrix(b["v"]), a["id"].to_numpy(), b["id"].to_numpy()
        same = a["a"].iloc[0] == b["b"].iloc[0]
        of_x = [_members(a[name].to_numpy()) for name in names]
        of_y = [_members(b[name].to_numpy()) for name in names]
        all_x, all_y = np.hstack([m for _, m in of_x]), np.hstack([m for _, m in of_y])
        to_y, to_x = np.zeros((len(x), all_y.shape[1])), np.zeros((len(y), all_x.shape[1]))
        for i in range(0, len(x), BLOCK_ROWS):
            p = slice(i, i + BLOCK_ROWS)
            for j in range(0, len(y), BLOCK_ROWS):
                q = slice(j, j + BLOCK_ROWS)
                table = distances(x[p], y[q])
                if same:
                    table[xs[p][:, None] == ys[q][None, :]] = 0.0
                else:
                    to_x[q] += table.T @ all_x[p]
                to_y[p] += table @ all_y[q]
        parts = []
        for which, name in enumerate(names):
            for side, ids, totals, of, wanted in ((a, xs, to_y, of_y, True), (b, ys, to_x, of_x, not same)):
                if wanted:
                    first = sum(len(found) for found, _ in of[:which])
                    found = of[which][0]
                    part = _sums(ids, side[name].to_numpy(), totals[:, first:first + len(found)], found)
                    parts.append(part.assign(which=which))
        return pd.concat(parts)

    cells = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(
        meet, f"which int, id {kind['id']}, own {kind['cluster0']}, other {kind['cluster0']}, total double"
    )
    return cells.groupBy("which", "id", "own", "other").agg(F.sum("total").alias("total"))


def values(df: DataFrame, key: str, column: str, cluster: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, cluster, a, b, silhouette) of every row; rows of singleton clusters get 0."""
    return _from_sums(df, distance_sums(df, key, column, cluster, block_rows), key, cluster)


def _from_sums(df: DataFrame, sums: DataFrame, key: str, cluster: str) -> DataFrame:
    sizes = cut(df.groupBy(F.col(cluster).alias("other")).agg(F.count("*").alias("size")))   # one row per cluster
    mean = lookup_join(sums, sizes, "other")
    inside = F.col("own") == F.col("other")
    per_row = mean.groupBy("id", "own").agg(
        F.max(F.when(inside, F.col("size"))).alias("size"),
        F.max(F.when(inside & (F.col("size") > 1), F.col("total") / F.nullif(F.col("size") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~inside, F.col("total") / F.col("size"))).alias("b"),
    )
    ratio = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    s = F.when((F.col("size") > 1) & F.col("b").isNotNull(), F.coalesce(ratio, F.lit(0.0))).otherwise(0.0)
    return per_row.select(F.col("id").alias(key), F.col("own").alias(cluster), "a", "b", s.alias("silhouette"))


def euclidean_scores(df: DataFrame, key: str, column: str, clusters: list[str], block_rows: int = BLOCK_ROWS) -> list[float]:
    """``score`` of several clusterings of the same rows; distances are worked out once for all."""
    several = [c for c in clusters if df.select(c).distinct().limit(2).count() > 1]
    if not several:
        return [0.0] * len(clusters)
    sums = cut(distance_sums_many(df, key, column, several, block_rows))
    found = {c: _from_sums(df, sums.filter(F.col("which") == i).drop("which"), key, c).agg(F.avg("silhouette")).first()[0]
             for i, c in enumerate(several)}
    return [found.get(c, 0.0) for c in clusters]


def score(df: DataFrame, key: str, column: str, cluster: str, measure: str = "euclidean") -> float:
    """Mean silhouette; 0 when there is only one cluster."""
    if df.select(cluster).distinct().limit(2).count() < 2:
        return 0.0
    if measure == "euclidean":
        return values(df, key, column, cluster).agg(F.avg("silhouette")).first()[0]
    if measure != "squared":
        raise ValueError("measure is 'euclidean' or 'squared'")
    rows = df.select(
        array_to_vector(F.col(column).cast("array<double>")).alias("features"),
        F.col(cluster).cast("double").alias("prediction"),
    )
    return ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(rows)
