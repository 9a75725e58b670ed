"""Exact top-k by inner product: longest vectors first, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are rotated by the right singular vectors of the whole table, so that
the first coordinates carry most of a product.  A candidate is dropped when its
length alone, or its partial sum plus the product of the remaining lengths,
cannot reach the query's k-th best score so far.  Survivors are scored in
whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.llm.vectors import keep_best, lengths, matrix, search, valid

SCALE = 64
SEEDS = 4_096        # longest vectors, broadcast to give every query a first bound (about; rows are picked by length)
CHUNK = 1_024        # candidates in work at a time
QUERY_SLICE = 256    # queries in work at a time
GATHER = 50_000      # pairs whose whole rows are gathered at a time
PARTS = (0.25, 0.5)  # shares of the coordinates after which bounds are tested
DENSE = 1 / 32       # share of open pairs above which whole blocks are multiplied instead of gathered rows
SLACK = 1e-9         # relative room for rounding in the bounds


def gram(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products over all rows: one small matrix per task."""
    def add(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(batch["v"], width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([i]) for i in [0]] + [pa.array([total.ravel()], pa.list_(pa.float64()))], ["k", "g"])

    parts = rows.select("v").mapInArrow(add, "k long, g array<double>")
    sums = parts.select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    return np.array([r.x for r in sorted(sums)]).reshape(width, width)


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    _, vectors = np.linalg.eigh(gram(rows, width))
    return vectors[:, ::-1]


def dots(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact whole-number products of paired rows; doubles hold every partial sum if lengths multiply to at most ``largest``."""
    if largest < 2**52:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))


def best_pairs(turn: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], top: int):
    """The search of one block of queries in one block of candidates."""
    def best(query_ids, queries, ids, candidates):
        size = np.linalg.norm(candidates, axis=1)
        order = np.argsort(-size, kind="stable")
        candidates, ids, size = candidates[order], ids[order], size[order]
        spun_q, spun_c, length = queries @ turn, candidates @ turn, np.linalg.norm(queries, axis=1)
        cuts = sorted({max(1, int(len(turn) * p)) for p in PARTS}) if len(turn) > 1 else []
        rest = [(np.linalg.norm(spun_q[:, c:], axis=1), np.linalg.norm(spun_c[:, c:], axis=1)) for c in cuts]
        bound = first_bound(query_ids, queries, *seeds, top)
        out = (np.zeros(0, np.int64),) * 3
        for low in range(0, len(ids), CHUNK):
            part = slice(low, low + CHUNK)
            room = SLACK * (1 + length * size[low])
            asked = np.flatnonzero(length * size[low] + room >= bound)
            if not len(asked):
                break
            largest = float(length.max() * size[0])
            fresh = []
            for first in range(0, len(asked), QUERY_SLICE):     # bounded work: a slice of queries meets a chunk of candidates
                sub = asked[first:first + QUERY_SLICE]
                sums, done, pairs, value = None, 0, None, None
                for c, (rest_q, rest_c) in zip(cuts, rest):
                    if pairs is None:
                        sums = spun_q[sub, done:c] @ spun_c[part, done:c].T
                        open_ = sums + rest_q[sub][:, None] * rest_c[part] + room[sub][:, None] >= bound[sub][:, None]
                        if largest < 2**52 and np.count_nonzero(open_) > DENSE * open_.size:
                            value = queries[sub] @ candidates[part].T       # whole numbers that doubles hold: exact, as ``dots``
                            q, x = np.nonzero(value >= bound[sub][:, None])
                            pairs, value = (sub[q], x + low), value[q, x].astype(np.int64)
                            break
                        q, x = np.nonzero(open_)
                        pairs, sums = (sub[q], x + low), sums[q, x]
                    else:
                        sums = sums + np.einsum("ij,ij->i", spun_q[pairs[0], done:c], spun_c[pairs[1], done:c])
                        keep = sums + rest_q[pairs[0]] * rest_c[pairs[1]] + room[pairs[0]] >= bound[pairs[0]]
                        pairs, sums = (pairs[0][keep], pairs[1][keep]), sums[keep]
                    done = c
                if pairs is None:
                    q, x = np.meshgrid(sub, np.arange(low, min(low + CHUNK, len(ids))), indexing="ij")
                    pairs = q.ravel(), x.ravel()
                keep = query_ids[pairs[0]] != ids[pairs[1]]
                q, x = pairs[0][keep], pairs[1][keep]
                if value is None:
                    value = np.concatenate([np.zeros(0, np.int64)] + [
                        dots(queries[q[i:i + GATHER]], candidates[x[i:i + GATHER]], largest) for i in range(0, len(q), GATHER)])
                else:
                    value = value[keep]
                keep = value >= bound[q]
                fresh.append((q[keep], ids[x[keep]], value[keep]))
                if first + QUERY_SLICE >= len(asked) or sum(len(f[0]) for f in fresh) > GATHER:      # slices share no query
                    *out, rank = keep_best(*(np.concatenate(column) for column in zip(out, *fresh)), top)
                    last = rank == top - 1
                    bound[out[0][last]] = np.maximum(bound[out[0][last]], out[2][last])
                    fresh = []
        return tuple(out)
    return best


def first_bound(query_ids, queries, seed_ids, seeds, top: int) -> np.ndarray:
    """The ``top``-th best score of each query among the seeds; minus infinity if there are too few."""
    bound = np.full(len(queries), -np.inf)
    if len(seeds) <= top:
        return bound
    for low in range(0, len(queries), 1_024):
        part = slice(low, low + 1_024)
        value = queries[part] @ seeds.T
        value[query_ids[part, None] == seed_ids[None]] = -np.inf
        bound[part] = np.floor(np.partition(value, len(seeds) - top, axis=1)[:, len(seeds) - top] * (1 - SLACK) - 0.5)
    return bound


def top_inner_products(rows: DataFrame, queries: Column, top: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``queries`` (over vec_id) holds, against all rows.

    Components become ``floor(64 * x)``.  A query's own id is no candidate;
    equal rows count once; ties go to the smaller vec_id; vectors of different
    lengths are not compared; null or non-finite vectors take no part.
    """
    rows = valid(rows).withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")))
    found = None
    for width in lengths(rows):
        own = rows.filter(F.size("v") == width)
        size = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
        n = own.count()
        # Rows of equal length are told apart by a hash, so that the number of seeds stays bounded.
        least = own.select(size.alias("s")).agg(F.percentile_approx("s", F.lit(max(0.0, 1 - SEEDS / n)), F.lit(10_000)).alias("p")).first().p
        long = own.filter(size >= least)
        chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, SEEDS / max(1, long.count()))))
        seeds = long.filter(chance).toArrow()
        seeds = (seeds["vec_id"].to_numpy(), matrix(seeds["v"], width))
        part = search(own, queries, best_pairs(rotation(own, width), seeds, top), top, "int64")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found
