"""Near duplicates by circulant MinHash.

Shingles are mapped to places 0 ... D - 1 by a first permutation (a mixed
64-bit hash, reduced).  A second permutation of the D places, shifted
circularly by k, gives coordinate k of the signature: two permutations make all
coordinates.  Coordinates are cut into bands; texts that share a band are
candidates, and every link is confirmed by the exact Jaccard similarity of the
full shingle sets.

Texts with equal sets are one class, held by one text.  Classes that share a
band form a candidate group.  A group's sets meet in tasks of bounded size: a
group over ``BLOCK_SHINGLES`` is cut into blocks, and every two of its blocks
meet once.  Inside a task, links found merge groups at once, so that texts
already connected are never compared again, and what leaves the task is a
forest with fewer links than texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inkgraph.llm.common import release_memory, texts
from inkgraph.llm.components import components
from inkgraph.llm.hashed_words import chunks, mix, split
from inkgraph.session import cut

WORDS = 5
PLACES = 1 << 20            # D
CHUNK = 2 << 20             # bytes of text in work at a time
BLOCK_SHINGLES = 3_000_000  # 8 bytes each
HOT_PARTS = 2_000           # a set with more than this part of all rows is not sent to one task
PAIR_KEY = np.uint64(0x9E3779B97F4A7C15)

@dataclass(frozen=True)
class Level:
    """Texts are linked if 100 * intersection >= ``percent`` * union; ``bands`` of ``rows`` coordinates find candidates."""

    percent: int
    bands: int
    rows: int

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


QUERY = Level(85, 40, 8)    # a pair of similarity 0.85 is missed with probability (1 - 0.85**8)**40 = 3e-6
STAGE = Level(80, 56, 7)    # a pair of similarity 0.80 is missed with probability (1 - 0.8**7)**56 = 2e-6

_rolled: dict[int, np.ndarray] = {}


def rolled(coordinates: int) -> np.ndarray:
    """Row i holds the second permutation at i, i + 1, ... (circularly): all coordinates of place i."""
    if coordinates not in _rolled:
        order = np.random.default_rng(4_711).permutation(PLACES).astype(np.uint32)
        _rolled[coordinates] = np.lib.stride_tricks.sliding_window_view(np.concatenate((order, order[:coordinates])), coordinates)
    return _rolled[coordinates]


def shingle_sets(data: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one."""
    found = split(data)
    word = found.hash
    count = np.diff(found.first)
    rolling = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for i in range(words):
        rolling = mix(rolling * PAIR_KEY + word[i: len(word) - words + 1 + i]) if len(rolling) else rolling
    out = []
    for first, n in zip(found.first[:-1], count):
        if n >= words:
            out.append(np.unique(rolling[first: first + n - words + 1]))
        elif n:
            key = np.array([n], np.uint64)
            for w in word[first: first + n]:
                key = mix(key * PAIR_KEY + w)
            out.append(key)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, level: Level) -> np.ndarray:
    """As many minima as the level has coordinates, each over all shingles."""
    place = (mix(shingles ^ PAIR_KEY) & np.uint64(PLACES - 1)).astype(np.int64)
    best = None
    for low in range(0, len(place), 2048):
        part = rolled(level.coordinates)[place[low: low + 2048]].min(axis=0)
        best = part if best is None else np.minimum(best, part)
    return best


def signatures(sets: list[np.ndarray], level: Level = QUERY) -> np.ndarray:
    return np.array([signature(s, level) for s in sets], np.uint32).reshape(len(sets), level.coordinates)


def band_keys(signs: np.ndarray, level: Level) -> np.ndarray:
    """One key for each text (row) and band."""
    rows = signs.reshape(len(signs), level.bands, level.rows).astype(np.uint64)
    key = np.repeat(np.arange(level.bands, dtype=np.uint64)[None], len(signs), axis=0)
    for i in range(level.rows):
        key = mix(key * PAIR_KEY + rows[:, :, i])
    return key.view(np.int64)


def prints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; equal sets have equal ones."""
    ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    both = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = []
    for salt in (7, 99):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(both ^ np.uint64(salt)), dtype=np.uint64)))
        out.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
    return out[0], out[1]


def _fingerprint(level: Level):
    def run(batches):
        """doc_id, set size, a 128-bit hash of the set, band keys (none for an empty set)."""
        for batch in batches:
            for low, high, data in chunks(batch["text"], CHUNK):
                sets = shingle_sets(data)
                full = [s for s in sets if len(s)]
                bands = band_keys(signatures(full, level), level).ravel()
                ends = np.concatenate(([0], np.cumsum([level.bands * (len(s) > 0) for s in sets]))).astype(np.int32)
                print_a, print_b = prints(sets)
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(low, high - low), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(print_a), pa.array(print_b), pa.ListArray.from_arrays(pa.array(ends), pa.array(bands)),
                ], ["doc_id", "n_shingles", "print_a", "print_b", "bands"])
        release_memory()
    return run


class Forest:
    """Disjoint sets of 0 ... n - 1 that remember the links which joined them."""

    def __init__(self, n: int) -> None:
        self.parent, self.links = list(range(n)), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: 100 * |a and b| >= percent * |a or b| for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[place] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def linked(sets: list[np.ndarray], level: Level) -> list[tuple[int, int]]:
    """A forest of links with the same components as all exact links between sets that share a band.

    First each band's sets are compared with one of them; then what is still
    unconnected within a band is compared pair by pair.  Pairs that are already
    connected are skipped, and so are those whose signatures agree in so few
    coordinates that they could be linked only by a six-sigma error.
    """
    forest, signs = Forest(len(sets)), signatures(sets, level)
    keys, size = band_keys(signs, level), np.array([len(s) for s in sets])
    tried: set[tuple[int, int]] = set()
    share = level.percent / 100
    agree = share - 6.5 * np.sqrt(share * (1 - share) / signs.shape[1])

    def attempt(i: int, others: np.ndarray) -> None:
        near = others[100 * np.minimum(size[others], size[i]) >= level.percent * np.maximum(size[others], size[i])]
        near = near[(signs[near] == signs[i]).mean(axis=1) >= agree]
        for j in near.tolist():
            pair = (min(i, j), max(i, j))
            if pair not in tried and forest.root(i) != forest.root(j):
                tried.add(pair)
                if similar(sets[i], sets[j], level.percent):
                    forest.join(i, j)

    groups = []
    for band in range(keys.shape[1]):
        order = np.argsort(keys[:, band], kind="stable")
        edge = np.flatnonzero(np.diff(keys[order, band])) + 1
        groups += [g for g in np.split(order, edge) if len(g) > 1]
    for group in groups:
        attempt(int(group[0]), group[1:])
    for group in groups:
        while True:
            roots = np.array([forest.root(i) for i in group.tolist()])
            names, count = np.unique(roots, return_counts=True)
            if len(names) < 2:
                break
            i = int(group[np.flatnonzero(roots == names[count.argmin()])[0]])
            attempt(i, group[roots != forest.root(i)])
            group = group[group != i]      # it has met every other one of this band
    return forest.links


def _links(level: Level):
    def run(group: pa.Table) -> pa.Table:
        """Links (a, b) between the nodes of one group or of two of its blocks."""
        node = group["node"].to_pylist()
        found = linked([np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()], level)
        return pa.table({"a": pa.array([node[i] for i, _ in found], pa.int64()), "b": pa.array([node[j] for _, j in found], pa.int64())})
    return run


def _candidate_sets(batches):
    for batch in batches:
        for low, high, data in chunks(batch["text"]):
            sets = shingle_sets(data)
            print_a, print_b = prints(sets)
            own = [batch[c].slice(low, high - low) for c in ("node", "group", "block", "blocks", "print_a", "print_b")]
            right = (own[4].to_numpy() == print_a) & (own[5].to_numpy() == print_b)
            rows = pa.RecordBatch.from_arrays([*own[:4], pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "group", "block", "blocks", "shingles"])
            yield rows.filter(pa.array(right))


def near_duplicates(docs: DataFrame, block_shingles: int = BLOCK_SHINGLES, level: Level = QUERY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Components are those of all links of similarity ``level.percent`` or more; texts
    with equal non-empty sets are linked, texts without words (null or empty)
    with nothing.  An id on several rows is one node.  A row without an id gets
    the smallest id it is linked to; it is kept if there is none.
    """
    own = texts(docs)
    marks = cut(own.mapInArrow(_fingerprint(level), "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>"))
    key = ["n_shingles", "print_a", "print_b"]
    classes = marks.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    classes = cut(classes.filter("node is not null"))

    in_band = classes.select("node", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    edges = in_band.join(shared, "band").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = cut(components(edges).withColumnsRenamed({"id": "node", "component": "group"}))

    members = classes.select("node", *key).join(groups, "node")
    sizes = members.groupBy("group").agg(F.sum("n_shingles").alias("total"))
    blocks = F.ceil(F.col("total") / block_shingles).cast("int")
    placed = members.join(sizes, "group").withColumn("blocks", F.greatest(blocks, F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wanted = placed.select("node", "group", "block", "blocks", "print_a", "print_b").hint("shuffle_hash")
    sets = own.join(wanted, own["doc_id"] == wanted["node"]).select("node", "group", "block", "blocks", "print_a", "print_b", "text")
    sets = sets.mapInArrow(_candidate_sets, "node long, group long, block int, blocks int, shingles binary")
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda c: (c != F.col("block")) | (F.col("blocks") == 1))
    meeting = sets.select("node", "group", "block", "shingles", F.explode(other).alias("other")).select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "shingles"
    )
    links = meeting.groupBy("group", "low", "high").applyInArrow(_links(level), "a long, b long")
    found = cut(components(links))

    named = classes.join(found, classes["node"] == found["id"], "left").select(*key, F.coalesce("component", "node").alias("component_id"))
    named = cut(named.groupBy(*key).agg(F.min("component_id").alias("component_id")))
    component = F.coalesce("component_id", "doc_id")
    return _with_components(marks, named, key).select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _with_components(marks: DataFrame, named: DataFrame, key: list[str]) -> DataFrame:
    """``marks`` with the component of their set, if it has one.

    Sets held by more than one in ``HOT_PARTS`` rows, of which there are fewer than
    ``HOT_PARTS``, are broadcast, so that their copies stay where they are; the
    rows of all others meet their component by an exchange.
    """
    rows = marks.select("doc_id", *key)
    copies = rows.filter("n_shingles > 0").groupBy(*key).agg(F.count("*").alias("copies"))
    hot = copies.filter(F.col("copies") * HOT_PARTS > rows.count()).select(*key)
    hot = cut(named.join(F.broadcast(hot), key))
    common = rows.join(F.broadcast(hot), key)
    other = rows.join(F.broadcast(hot), key, "left_anti").join(named, key, "left")
    return common.unionByName(other)
