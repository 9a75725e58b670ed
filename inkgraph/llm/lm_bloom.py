"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Every single token and every pair of neighbours in the training texts has its
count quantised to a level ``q = 1 + floor(log2(count))``; the filter holds the
entries (n-gram, 1) ... (n-gram, q).  The count of an n-gram is read back by
probing level after level until one is missing, so an error can only raise it.

The filter is built in shards by n-gram hash, each by one task from counts that
were summed map-side, sized for its own entries.  Shards are broadcast in
slices of at most ``slice_bytes``; if there are several, each slice takes one
pass over the texts and the levels found are put together per text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.llm.common import join_rows, row_key, texts, threshold_for
from inkgraph.llm.hashed_words import Tally, chunks, mix, split
from inkgraph.session import cut

END = np.uint64(0x5BD1E9955BD1E995)      # hash of the end of a text, counted as a token
BEGIN = np.uint64(0xC2B2AE3D27D4EB4F)    # hash of what stands before the first token
PAIR = np.uint64(0xD6E8FEB86659FD93)
PROBE = np.uint64(0xA0761D6478BD642F)
PROBES = 5
BITS_PER_ENTRY = 10
SHARD_TOKENS = 1 << 20                   # training tokens for which one shard is planned
SLICE_BYTES = 128 << 20                  # filter bytes broadcast at a time
FREQUENT = 1 << 21                       # counts broadcast, 16 bytes each; the rest are joined
PRIOR = 2.0                              # weight of the single-token model in a pair's probability


def tokens_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text closed by the end token, and where each text begins."""
    words = split(data)
    count = np.diff(words.first)
    first = np.concatenate(([0], np.cumsum(count + 1)))
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(words.start)) + np.repeat(np.arange(len(count)), count)] = words.hash
    return out, first


def pairs_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (or the begin mark)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = BEGIN
    return mix(before * PAIR + tokens)


def signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def _tally(batches, keys_of):
    tally = Tally()

    def flush():
        keys, n = tally.take()
        for low in range(0, len(keys), 500_000):
            part = slice(low, low + 500_000)
            yield pa.RecordBatch.from_arrays([signed(keys[part]), pa.array(n[part])], ["key", "n"])

    for batch in batches:
        for _, _, data in chunks(batch["text"]):
            tally.add(keys_of(*tokens_of(data)))
            if tally.full():
                yield from flush()
    yield from flush()


def token_counts(docs: DataFrame) -> DataFrame:
    """(key, n): how often each token stands in the texts."""
    counted = docs.select("text").mapInArrow(lambda b: _tally(b, lambda tokens, _: tokens), "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def filter_shards(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, bits): one Bloom filter for each part of the n-grams' hash range."""
    def keys(tokens, first):
        return np.concatenate((tokens, pairs_of(tokens, first)))

    partial = docs.select("text").mapInArrow(lambda b: _tally(b, keys), "key long, n long")
    place = F.pmod("key", F.lit(shards)).cast("int")

    def build(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            key, n = (batch[c].to_numpy() for c in ("key", "n"))
            shard = np.mod(key, shards)
            for s in np.unique(shard):
                parts.setdefault(int(s), []).append((key[shard == s], n[shard == s]))
        for s, found in parts.items():
            key, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            level = 1 + np.floor(np.log2(np.bincount(back, np.concatenate([n for _, n in found])))).astype(int)
            size = -(-int(level.sum()) * BITS_PER_ENTRY // 8) * 8
            bits = np.zeros(size, np.uint8)
            for q in range(1, int(level.max()) + 1):
                code = key[level >= q].view(np.uint64)
                for probe in range(PROBES):
                    bits[bit_of(code, q, probe, np.uint64(size))] = 1
            packed = np.packbits(bits, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([packed], pa.binary())], ["shard", "bits"])

    return partial.repartition(shards, place).mapInArrow(build, "shard int, bits binary")


def bit_of(code: np.ndarray, level: int, probe: int, size) -> np.ndarray:
    return mix(code + np.uint64((level * PROBES + probe + 1) * int(PROBE) % 2**64)) % size


class Filter:
    """Some shards of the whole filter; n-grams of other shards get level 0."""

    def __init__(self, rows: list[tuple[int, bytes]], shards: int) -> None:
        self.shards = shards
        self.size = np.zeros(shards, np.uint64)
        self.offset = np.zeros(shards, np.uint64)
        at = 0
        for shard, bits in rows:
            self.size[shard], self.offset[shard] = len(bits) * 8, at
            at += len(bits)
        self.bits = np.frombuffer(b"".join(bits for _, bits in rows), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        shard = np.mod(keys.view(np.int64), self.shards)
        out = np.zeros(len(keys), np.uint8)
        alive = np.flatnonzero(self.size[shard] > 0)
        level = 1
        while len(alive):
            code, size, offset = keys[alive], self.size[shard[alive]], self.offset[shard[alive]]
            for probe in range(PROBES):
                bit = bit_of(code, level, probe, size)
                byte = self.bits[(offset + (bit >> np.uint64(3))).astype(np.int64)]
                hit = (byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                alive, code, size, offset = alive[hit], code[hit], size[hit], offset[hit]
            out[alive] = level
            level += 1
        return out


def count_of(level: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its range, 1 for level 1, 0 for level 0."""
    return np.where(level > 1, 1.5 * np.exp2(level.astype(float) - 1), level.astype(float))


def log_probability(single: np.ndarray, pair: np.ndarray, first: np.ndarray, texts_seen: int, total: int, distinct: int):
    """log10 p per text: pair counts, smoothed towards the single-token model (Dirichlet prior)."""
    count = count_of(single)
    own = (count + 0.5) / (total + 0.5 * (distinct + 1))
    before = np.empty_like(count)
    before[1:] = count[:-1]
    before[first[:-1]] = texts_seen
    value = np.log10((np.minimum(count_of(pair), np.maximum(before, 1)) + PRIOR * own) / (before + PRIOR))
    return np.add.reduceat(value, first[:-1]) if len(first) > 1 else np.zeros(0)


def find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, known) from sorted keys."""
    if not len(table[0]):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    known = table[0][place] == keys
    return np.where(known, table[1][place], 0), known


def score(docs: DataFrame, train: Column, slice_bytes: int = SLICE_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """Scores of every text under the models learned from the rows where ``train`` holds.

    Returns (doc_id, text_key, n_tokens, n_known, train_tokens, base_score, score).
    Base: add-half smoothing over exact token counts.  A null or empty text has
    the end token alone; repeated rows give repeated results; with nothing to
    learn from, N and V are 0 and the base is ``log10(0.5 / 0.5) = 0`` a token.
    Tokens beyond the ``frequent`` most common ones get their counts by a join.
    """
    spark = docs.sparkSession
    own = texts(docs, train.alias("train"))
    learned = own.filter("train")
    counts = cut(token_counts(learned))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    seen = learned.count()
    shards = max(1, -(-total // SHARD_TOKENS))
    built = cut(filter_shards(learned, shards))
    sizes = {r.shard: r.size for r in built.select("shard", F.length("bits").alias("size")).collect()}

    least = threshold_for(counts, "n", frequent)
    common = counts.filter(F.col("n") >= least).toArrow()
    order = np.argsort(common["key"].to_numpy().view(np.uint64))
    known = (common["key"].to_numpy().view(np.uint64)[order], common["n"].to_numpy()[order])
    known_shared = spark.sparkContext.broadcast(known)

    slices: list[list[int]] = [[]]
    for shard in sorted(sizes):
        if slices[-1] and sum(sizes[s] for s in slices[-1]) + sizes[shard] > slice_bytes:
            slices.append([])
        slices[-1].append(shard)

    def broadcast_slice(part: list[int]):
        rows = built.filter(F.col("shard").isin(part)).toArrow() if part else None
        rows = list(zip(rows["shard"].to_pylist(), rows["bits"].to_pylist())) if rows else []
        return spark.sparkContext.broadcast(Filter(rows, shards))

    def base_part(tokens, first):
        """Sums over the tokens with a known count; the others as (key, times) lists per text."""
        keys, back = np.unique(tokens, return_inverse=True)
        n, has = find(known_shared.value, keys)
        value = np.where(has, np.log10(n + 0.5), 0.0)[back]
        missing = np.flatnonzero(~has[back])
        return (np.add.reduceat(value, first[:-1]), np.add.reduceat(has[back].astype(np.int64), first[:-1]),
                tokens[missing], np.searchsorted(missing, first))

    def levels_part(tokens, first, grams):
        keys, back = np.unique(tokens, return_inverse=True)
        return grams.levels(keys)[back], grams.levels(pairs_of(tokens, first))

    def whole(shared):
        def run(batches):
            for batch in batches:
                for low, high, data in chunks(batch["text"]):
                    tokens, first = tokens_of(data)
                    base, hits, rest, rest_first = base_part(tokens, first)
                    single, pair = levels_part(tokens, first, shared.value)
                    value = log_probability(single, pair, first, seen, total, distinct)
                    rest = pa.ListArray.from_arrays(pa.array(rest_first, pa.int32()), signed(rest))
                    yield pa.RecordBatch.from_arrays([
                        batch["doc_id"].slice(low, high - low), batch["text_key"].slice(low, high - low),
                        pa.array(np.diff(first)), pa.array(hits), pa.array(base), rest, pa.array(value),
                    ], ["doc_id", "text_key", "n_tokens", "hits", "base", "rest", "score"])
        return run

    def part(shared):
        def run(batches):
            for batch in batches:
                for low, high, data in chunks(batch["text"]):
                    tokens, first = tokens_of(data)
                    found = levels_part(tokens, first, shared.value)
                    at = list(zip(first[:-1], first[1:]))
                    yield pa.RecordBatch.from_arrays([
                        batch["doc_id"].slice(low, high - low), batch["text_key"].slice(low, high - low),
                        *[pa.array([x[a:b].tobytes() for a, b in at], pa.binary()) for x in found],
                    ], ["doc_id", "text_key", "single", "pair"])
        return run

    def together(group: pa.Table) -> pa.Table:
        """Each level was found in one slice and is 0 in the others."""
        single, pair = (
            np.max([np.frombuffer(x, np.uint8) for x in group[c].to_pylist()], axis=0) for c in ("single", "pair")
        )
        value = log_probability(single, pair, np.array([0, len(single)]), seen, total, distinct)
        return group.select(["doc_id", "text_key"]).slice(0, 1).append_column("score", pa.array(value))

    rows = own.select("doc_id", "text", row_key())
    scored = "doc_id long, text_key long, n_tokens long, hits long, base double, rest array<long>, score double"
    first_pass = cut(rows.mapInArrow(whole(broadcast_slice(slices[0])), scored))
    if len(slices) > 1:
        passes = [rows.mapInArrow(part(broadcast_slice(s)), "doc_id long, text_key long, single binary, pair binary") for s in slices]
        found = passes[0]
        for one in passes[1:]:
            found = found.unionByName(one)
        values = found.groupBy("doc_id", "text_key").applyInArrow(together, "doc_id long, text_key long, score double")
        first_pass = join_rows(first_pass.drop("score"), values)

    rest = first_pass.filter(F.size("rest") > 0).dropDuplicates(["doc_id", "text_key"])
    rest = rest.select("doc_id", "text_key", F.explode("rest").alias("key"))
    rare = counts.filter(F.col("n") < least)
    joined = rest.join(rare, "key", "left").groupBy("doc_id", "text_key").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count("n").alias("more_hits")
    )
    scale = float(np.log10(total + 0.5 * (distinct + 1)))
    return join_rows(first_pass, joined).select(
        "doc_id", "text_key", "n_tokens",
        (F.col("hits") + F.coalesce("more_hits", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"), "score",
    )
