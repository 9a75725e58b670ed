"""Many KMeans fits in one pass per round: all restarts, and all k of a sweep, move together.

Every round reads the points once.  Each task measures its points against the
centroids of every fit (one matrix product), assigns each point once per fit and
sends partial sums per centroid; Spark adds them (map-side first) and only
``fits x k x dim`` numbers reach the driver, which moves the centroids.  A fit
stops when the squared moves of its centroids add up to at most ``tol`` times the
mean variance of the features; the loop ends when all
have converged or after ``max_iter`` rounds.

Seeds come from one k-means|| pool shared by all fits: a first point chosen by
hash, then ``rounds`` passes that each add points with chance proportional to
their squared distance to the pool (an oversampling of ``oversample`` per pass),
then one pass that weights each pool point by the points nearest to it.  Each fit
draws its k seeds from the weighted pool by k-means++ with its own seed and moves
them by weighted Lloyd rounds on the pool alone.  The
pool is bounded by ``1 + rounds * oversample`` points on average.

Rows whose vector is null, of another length or not finite take no part and get
a null cluster.  An empty cluster keeps its centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from inkgraph.session import cut

ROUNDS = 3
OVERSAMPLE = 64


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.stack(batch["v"].to_numpy()).astype(np.float64) if len(batch) else np.empty((0, 0))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    return np.maximum(d2, 0.0)


@dataclass(frozen=True)
class Fits:
    """Centroids of all fits, fit by fit; ``ks[f]`` centroids belong to fit f."""

    ks: list[int]
    centres: np.ndarray

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.ks)])


def _assign(x: np.ndarray, fits: Fits) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (global number) and its squared distance, per point and fit; ties to the lower number."""
    d2 = _distances(x, fits.centres)
    off = fits.offsets
    nearest = np.empty((len(x), len(fits.ks)), np.int64)
    cost = np.empty((len(x), len(fits.ks)))
    for f in range(len(fits.ks)):
        part = d2[:, off[f]:off[f + 1]]
        j = part.argmin(1)
        nearest[:, f] = off[f] + j
        cost[:, f] = part[np.arange(len(x)), j]
    return nearest, cost


def _round(points: DataFrame, fits: Fits, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums C x dim, counts C, cost per centroid) for the centroids of ``fits``: one pass over ``points``."""
    shared = points.sparkSession.sparkContext.broadcast(fits)
    n_c = len(fits.centres)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = shared.value
        sums, counts, cost = np.zeros((n_c, dim)), np.zeros(n_c, np.int64), np.zeros(n_c)
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            nearest, d2 = _assign(x, f)
            member = np.zeros((n_c, len(x)))
            member[nearest.T, np.arange(len(x))[None, :]] = 1.0     # each point once per fit
            sums += member @ x
            counts += np.bincount(nearest.ravel(), minlength=n_c)
            cost += np.bincount(nearest.ravel(), d2.ravel(), n_c)
        yield pd.DataFrame({"c": np.arange(n_c, dtype=np.int32), "n": counts, "cost": cost, "s": list(sums)})

    parts = points.mapInPandas(run, "c int, n long, cost double, s array<double>")
    whole = (parts.select("c", "n", "cost", F.posexplode("s").alias("d", "x"))
             .groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("x").alias("x"))).toPandas()
    sums, counts, cost = np.zeros((n_c, dim)), np.zeros(n_c, np.int64), np.zeros(n_c)
    if len(whole):
        c, d = whole["c"].to_numpy(), whole["d"].to_numpy()
        sums[c, d] = whole["x"].to_numpy()
        first = d == 0
        counts[c[first]] = whole["n"].to_numpy()[first]
        cost[c[first]] = whole["cost"].to_numpy()[first]
    return sums, counts, cost


def _seed_pool(points: DataFrame, seed: int, rounds: int, oversample: int) -> np.ndarray:
    """k-means||: a pool of points, each pass adding points by squared distance to the pool."""
    first = points.orderBy(F.xxhash64(F.lit(seed), "id"), "id").select("v").first()
    pool = np.asarray([first["v"]], dtype=np.float64)
    for r in range(rounds):
        shared = points.sparkSession.sparkContext.broadcast(pool)

        def cost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0.0
            for batch in batches:
                x = _matrix(batch)
                if len(x):
                    total += _distances(x, shared.value).min(1).sum()
            yield pd.DataFrame({"cost": [total]})

        phi = points.mapInPandas(cost, "cost double").agg(F.sum("cost")).first()[0] or 0.0
        if phi <= 0:
            break

        def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = _matrix(batch)
                if not len(x):
                    continue
                d2 = _distances(x, shared.value).min(1)
                u = batch["u"].to_numpy()
                chosen = u < np.minimum(1.0, oversample * d2 / phi)
                if chosen.any():
                    yield pd.DataFrame({"v": [row.tolist() for row in x[chosen]]})

        uniform = (F.pmod(F.xxhash64(F.lit(seed), F.lit(r), "id"), F.lit(1 << 30)) / float(1 << 30)).alias("u")
        found = points.select("id", "v", uniform).mapInPandas(pick, "v array<double>").toPandas()
        if len(found):
            pool = np.vstack([pool, np.stack(found["v"].to_numpy())])
    return pool


def _weights(points: DataFrame, pool: np.ndarray) -> np.ndarray:
    shared = points.sparkSession.sparkContext.broadcast(pool)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            x = _matrix(batch)
            if len(x):
                n += np.bincount(_distances(x, shared.value).argmin(1), minlength=len(n))
        yield pd.DataFrame({"i": np.arange(len(n), dtype=np.int32), "n": n})

    got = points.mapInPandas(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    w = np.zeros(len(pool))
    w[got["i"].to_numpy()] = got["n"].to_numpy()
    return w


def _plus_plus(pool: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k seeds from a weighted pool by k-means++; fewer distinct pool points than k repeat the last."""
    w = np.maximum(weights, 0) + 1e-12
    chosen = [rng.choice(len(pool), p=w / w.sum())]
    for _ in range(1, k):
        d2 = _distances(pool, pool[chosen]).min(1) * w
        if d2.sum() <= 0:
            chosen.append(chosen[-1])
            continue
        chosen.append(rng.choice(len(pool), p=d2 / d2.sum()))
    return pool[chosen]


def _refine(pool: np.ndarray, weights: np.ndarray, seeds: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weighted Lloyd rounds on the pool alone (it is bounded), as k-means|| does before the passes over all points."""
    centres = seeds.copy()
    for _ in range(rounds):
        nearest = _distances(pool, centres).argmin(1)
        mass = np.bincount(nearest, weights, len(centres))
        moved = centres.copy()
        filled = mass > 0
        moved[filled] = (np.stack([np.bincount(nearest, weights * pool[:, d], len(centres)) for d in range(pool.shape[1])], 1)[filled]
                         / mass[filled, None])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


@dataclass(frozen=True)
class Result:
    ks: list[int]
    centres: list[np.ndarray]     # per fit
    inertia: np.ndarray           # per fit
    rounds: int

    def best(self, k: int) -> tuple[np.ndarray, float]:
        """Centroids and inertia of the lowest-inertia fit with ``k`` clusters (first such fit on ties)."""
        fits = [f for f, kk in enumerate(self.ks) if kk == k]
        f = min(fits, key=lambda i: (self.inertia[i], i))
        return self.centres[f], float(self.inertia[f])


def valid_points(df: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """(id, v) of rows with a whole, finite vector of the most common length, and that length."""
    v = F.col(column).cast("array<double>")
    ok = v.isNotNull() & (F.size(v) > 0) & (F.size(F.filter(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))) == 0)
    rows = df.select(F.col(key).alias("id"), v.alias("v")).filter(ok)
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return rows, 0
    return cut(rows.filter(F.size("v") == lengths["dim"])), int(lengths["dim"])


def fit_many(df: DataFrame, key: str, column: str, ks: list[int], restarts: int, seed: int = 42,
             max_iter: int = 300, tol: float = 1e-4) -> Result:
    """``restarts`` fits for each k of ``ks``, all moved in the same passes.

    A fit has converged when the squared shifts of its centroids add up to at most
    ``tol`` times the mean variance of the features (the usual rule of KMeans); its
    last move is kept and it moves no further.
    """
    points, dim = valid_points(df, key, column)
    n = points.count()
    ks = [k for k in ks if k <= n]
    if not ks or dim == 0:
        return Result([], [], np.zeros(0), 0)
    pool = _seed_pool(points, seed, ROUNDS, max(OVERSAMPLE, 2 * max(ks)))
    weights = _weights(points, pool)
    fits_k = [k for k in ks for _ in range(restarts)]
    seeds = [_refine(pool, weights, _plus_plus(pool, weights, k, np.random.default_rng([seed, i]))) for i, k in enumerate(fits_k)]
    fits = Fits(fits_k, np.vstack(seeds))
    off = fits.offsets
    total, count, squares = _round(points, Fits([1], np.zeros((1, dim))), dim)     # sum, rows, sum of squares
    variance = max(0.0, float(squares[0] / count[0] - ((total[0] / count[0]) ** 2).sum()) / dim)
    limit = tol * variance
    moving = np.ones(len(fits_k), bool)
    done = 0
    for done in range(1, max_iter + 1):
        sums, counts, _ = _round(points, fits, dim)
        moved = fits.centres.copy()
        filled = counts > 0
        moved[filled] = sums[filled] / counts[filled, None]
        still = np.repeat(~moving, fits_k)          # converged in an earlier round
        moved[still] = fits.centres[still]
        shift = ((moved - fits.centres) ** 2).sum(1)
        for f in np.flatnonzero(moving):
            if shift[off[f]:off[f + 1]].sum() <= limit:
                moving[f] = False
        fits = Fits(fits_k, moved)
        if not moving.any():
            break
    _, _, cost = _round(points, fits, dim)       # inertia of the final centroids
    inertia = np.array([cost[off[f]:off[f + 1]].sum() for f in range(len(fits_k))])
    return Result(fits_k, [fits.centres[off[f]:off[f + 1]] for f in range(len(fits_k))], inertia, done)


def assign(df: DataFrame, column: str, centres: np.ndarray, out: str = "cluster") -> DataFrame:
    """``df`` with the number of the nearest centroid (ties to the lower number; null for an invalid vector)."""
    v = F.col(column).cast("array<double>")
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    d2 = F.transform(table, lambda c, i: F.struct(
        F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x).alias("d2"), i.alias("c")))
    ok = v.isNotNull() & (F.size(v) == len(centres[0])) & (F.size(F.filter(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))) == 0)
    return df.withColumn(out, F.when(ok, F.array_min(d2)["c"]))
