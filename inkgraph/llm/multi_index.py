"""Approximate nearest neighbours: learned rotated binary codes, scanned and reranked.

Codes are the signs of several learned rotations (principal directions, turned
so that signs lose least) of each vector.  Every query's code is compared with
every code of a block; rows within the query's radius are reranked by their
true products.  No substring index is built: at the radii learned, its probes
(``within``) would cover nearly all rows.

The radius is learned from queries drawn from a bounded sample: the distance
within which the given share of true neighbours lies, and, by how far a query's
own k-th code is, the margin beyond that code within which this share lies.  A
query takes the larger of the radius and its k-th code's distance in the block
plus the margin, so that queries in sparse regions look further.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.llm.vectors import keep_best, lengths, matrix, search, valid

BITS = 256             # of a code, for vectors of up to that many components
SAMPLE = 12_000        # rows that codes and radius are learned from, at most (in expectation)
SAMPLE_QUERIES = 300
SHARE = 0.97           # of the sample's true neighbours lie within the radius
TURNS = 20             # rounds of fitting a rotation
DENSITIES = 10         # groups of sampled queries, by the distance of their k-th code, with a margin each
ROWS = 512             # queries in work at a time
NEAR = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], np.uint8)


def learn_rotations(sample: np.ndarray, bits: int, seed: int = 5) -> np.ndarray:
    """Directions (width x bits): repeated fits of a rotation of the principal directions to its own signs."""
    rng, width = np.random.default_rng(seed), sample.shape[1]
    _, principal = np.linalg.eigh(sample.T @ sample)
    spun, out = sample @ principal, []
    for _ in range(-(-bits // width)):
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(TURNS):
            left, _, right = np.linalg.svd(np.sign(spun @ turn).T @ spun)
            turn = (left @ right).T
        out.append(principal @ turn)
    return np.concatenate(out, axis=1)[:, : -(-bits // 8) * 8]


def codes(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """One row of bytes per vector."""
    return np.packbits(vectors @ directions > 0, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which every code of ``a`` differs from every code of ``b``."""
    pad = -a.shape[1] % 8
    a, b = (np.ascontiguousarray(np.pad(x, ((0, 0), (0, pad)))).view(np.uint64) for x in (a, b))
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        out += np.bitwise_count(a[:, i, None] ^ b[None, :, i])
    return out


@dataclass(frozen=True)
class Radius:
    """``margins[i]`` holds for queries whose k-th code is at ``from_[i]`` or further (and nearer than ``from_[i + 1]``)."""

    least: int
    from_: np.ndarray
    margins: np.ndarray

    def of(self, kth: np.ndarray) -> np.ndarray:
        """The radius of each query, given the distance of its k-th code."""
        group = np.maximum(0, np.searchsorted(self.from_, kth, side="right") - 1)
        return np.maximum(self.least, kth + self.margins[group])


def learn_radius(sample: np.ndarray, directions: np.ndarray, top: int, share: float = SHARE) -> Radius:
    """What ``share`` of the true neighbours of queries from all over the sample lie within."""
    k = min(top, len(sample) - 1)
    if k < 1:
        return Radius(directions.shape[1], np.zeros(1, int), np.zeros(1, int))
    at = np.random.default_rng(9).permutation(len(sample))[:SAMPLE_QUERIES]
    product = sample[at] @ sample.T
    product[np.arange(len(at)), at] = -np.inf
    true = np.argpartition(-product, k - 1, axis=1)[:, :k]
    far = distances(codes(sample[at], directions), codes(sample, directions)).astype(int)
    away = np.take_along_axis(far, true, axis=1)
    far[np.arange(len(at)), at] = 65_535
    kth = np.partition(far, k - 1, axis=1)[:, k - 1]
    groups = np.array_split(np.argsort(kth, kind="stable"), min(DENSITIES, len(at)))
    margins = [int(np.quantile(away[g] - kth[g, None], share, method="higher")) for g in groups]
    from_ = np.array([kth[g[0]] for g in groups])
    return Radius(int(np.quantile(away, share, method="higher")), from_, np.maximum(0, np.maximum.accumulate(margins)))


def within(query_codes: np.ndarray, row_codes: np.ndarray, radius: int) -> np.ndarray:
    """Pigeonhole probing: True for every code within ``radius`` (and maybe for others), per query."""
    m = query_codes.shape[1]
    most = np.full(m, radius // m)
    most[radius % m + 1:] -= 1
    hit = np.zeros((len(query_codes), len(row_codes)), bool)
    for s in range(m):
        probed = NEAR[query_codes[:, s]] <= most[s]         # the keys of this substring's index to look up
        hit |= np.take(probed, row_codes[:, s], axis=1)
    return hit


def best_pairs(directions: np.ndarray, radius: Radius, top: int):
    def best(query_ids, queries, ids, rows):
        row_codes, out = codes(rows, directions), []
        for low in range(0, len(queries), ROWS):
            asked = queries[low: low + ROWS]
            query_codes = codes(asked, directions)
            far = distances(query_codes, row_codes)
            own = query_ids[low: low + ROWS, None] == ids[None]
            far[own] = 65_535
            kth = np.partition(far, min(top, len(ids)) - 1, axis=1)[:, min(top, len(ids)) - 1].astype(int)
            hit = (far <= radius.of(kth)[:, None]) & ~own
            q, x = np.nonzero(hit)
            value = np.concatenate([np.zeros(0)] + [
                np.einsum("ij,ij->i", asked[q[a: a + 200_000]], rows[x[a: a + 200_000]]) for a in range(0, len(q), 200_000)
            ])
            q, found, value, _ = keep_best(q, ids[x], value, top)
            out.append((q + low, found, value))
        return tuple(np.concatenate(x) for x in zip(*out))
    return best


def nearest(rows: DataFrame, queries: Column, top: int = 20, bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``queries`` (over vec_id) holds, among all rows.

    Score: inner product in double precision.  A query's own id is no candidate;
    equal rows count once; ties go to the smaller vec_id; vectors of different
    lengths are not compared; null, zero or non-finite vectors take no part.
    """
    rows = valid(rows).filter(F.exists("v", lambda x: x != 0))
    found = None
    for width in lengths(rows):
        own = rows.filter(F.size("v") == width)
        chance = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, SAMPLE / own.count())))
        sample = own.filter(chance).toArrow()
        sample = matrix(sample["v"], width)[np.argsort(sample["vec_id"].to_numpy(), kind="stable")]
        directions = learn_rotations(sample, max(bits, width))
        part = search(own, queries, best_pairs(directions, learn_radius(sample, directions, top), top), top, "double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found
