"""Byte-pair encoding by a table of distinct words, and decoding by a table of pieces.

A word is a stretch of text that no token crosses: one white-space character
and what follows it up to the next.  Words are told apart by 64-bit hashes.  The
words of a bounded sample of texts are encoded first and broadcast (a bounded
table of hashes and ids).  The other words of each text go out as (chunk,
position, word); all occurrences of a word meet in one task, which encodes it
once and sends its ids back to their positions.  Nothing else of the text
moves: meanwhile each text is held as its known ids with marked gaps.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from inkgraph.llm.common import texts, threshold_for
from inkgraph.llm.hashed_words import IS_SPACE, Words, chunks
from inkgraph.session import cut

SAMPLE_DOCS = 30_000       # texts whose words fill the broadcast table, at most (in expectation)
BROADCAST_WORDS = 2_000_000
BROADCAST_BYTES = 32       # longer words are never broadcast
SAMPLE_CHUNK = 4 << 20
CHUNK = 2 << 20            # bytes of text whose gaps are filled together
ENCODED_AT_ONCE = 4_000
KEPT_WORDS = 100_000       # rare words whose ids a task remembers

# Fixed value: white space beyond ASCII.
WIDE_SPACE = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
PARTS = re.compile(r"\s*\S+|\s+")


def words(data: list[bytes], special: tuple[bytes, ...] = ()) -> Words:
    """The words of all texts; those of one text, joined, are the text.

    Cuts are made before the first and before the last character of a run of
    ASCII white space.  Both leave all tokens as they are: the tokenizer takes a
    run but for its last character as one token, and the last one with what
    follows.  Texts with other white space, or with the ``special`` strings of a tokenizer, are cut before whole runs only.
    """
    joined = b"".join(data)
    raw = np.frombuffer(joined, np.uint8)
    at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))))
    space = IS_SPACE[raw]
    begins = np.zeros(len(raw) + 1, bool)
    if len(raw):
        begins[:-2] = space[:-1] & ~space[1:]
        begins[np.maximum(at[1:] - 1, 0)] = False        # a run at the end of a text is one token
        begins[1:-1] |= space[1:] & ~space[:-1]
    begins[at] = True
    present = [s for s in (*WIDE_SPACE, *special) if s in joined]
    if present:
        for i, text in enumerate(data):
            if any(s in text for s in present):
                sizes = [len(w.encode()) for w in PARTS.findall(text.decode("utf-8", "replace"))]
                if sum(sizes) == len(text):
                    begins[at[i]: at[i + 1]] = False
                    begins[at[i] + np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)] = True
    edge = np.flatnonzero(begins)
    start, end = edge[:-1], edge[1:]
    return Words(raw, start, end, np.searchsorted(start, at))


def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallel part
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def encode_words(path: str, kind: str = "<u4"):
    """Adds ids (as numbers of that kind) to batches with a column ``word``; a word met again in the task is not encoded again."""
    def run(batches):
        encoder, known = tokenizer(path), {}
        for batch in batches:
            found = batch["word"].to_pylist()
            if len(known) > KEPT_WORDS:
                known.clear()
            fresh = list(dict.fromkeys(w for w in found if w not in known))
            for low in range(0, len(fresh), ENCODED_AT_ONCE):
                some = fresh[low: low + ENCODED_AT_ONCE]
                for word, one in zip(some, encoder.encode_batch_fast(some, add_special_tokens=False)):
                    known[word] = np.array(one.ids, kind).tobytes()
            rest = [c for c in batch.schema.names if c != "word"]
            ids = pa.array([known[w] for w in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in rest], ids], [*rest, "ids"])
    return run


def count_words(batches):
    """(word, n) of each chunk's distinct short words."""
    for batch in batches:
        for _, _, data in chunks(batch["text"], SAMPLE_CHUNK):
            found = words(data)
            _, one, n = np.unique(found.hash, return_index=True, return_counts=True)
            short = (found.end - found.start)[one] <= BROADCAST_BYTES
            text = found.data.tobytes()
            word = [text[a:b] for a, b in zip(found.start[one[short]].tolist(), found.end[one[short]].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.binary()).cast(pa.string()), pa.array(n[short])], ["word", "n"])


class Table:
    """Ids by word hash: sorted hashes, and the ids of all words in one array."""

    def __init__(self, known: list[bytes], ids: list[bytes], kind: str, special: tuple[bytes, ...]) -> None:
        ends = np.cumsum(np.fromiter(map(len, known), np.int64, len(known)))
        starts = np.concatenate(([0], ends))[:-1]
        keys = Words(np.frombuffer(b"".join(known), np.uint8), starts, ends, np.array([0, len(known)])).hash
        order = np.argsort(keys)
        self.keys, self.kind, self.special = keys[order], kind, special
        self.size = (np.fromiter(map(len, ids), np.int64, len(ids)) // 4)[order].astype(np.int32)
        self.at = (np.cumsum(self.size) - self.size).astype(np.int64)
        self.ids = np.frombuffer(b"".join(ids[i] for i in order), "<u4").astype(kind)

    @property
    def gap(self) -> int:
        return int(np.iinfo(self.kind).max)

    def look_up(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """(row of the table, whether there is one) for each word."""
        keys, back = np.unique(found.hash, return_inverse=True)
        if not len(self.keys):
            return np.zeros(len(back), np.int64), np.zeros(len(back), bool)
        row = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return row[back], (self.keys[row] == keys)[back]

    def gapped(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids with a gap mark for each unknown word, and where each text's begin."""
        row, known = self.look_up(found)
        size = np.where(known, self.size[row] if len(self.size) else 0, 1)
        ends = np.cumsum(size)
        out = np.full(int(ends[-1]) if len(ends) else 0, self.gap, self.kind)
        n = size[known]
        from_ = np.repeat(self.at[row[known]] - (np.cumsum(n) - n), n) + np.arange(n.sum()) if n.sum() else np.zeros(0, np.int64)
        filled = np.repeat(known, size)
        out[filled] = self.ids[from_]
        return out, np.concatenate(([0], ends))[found.first]


def frequent_words(docs: DataFrame, path: str, most: int = BROADCAST_WORDS) -> Table:
    """The most frequent words of a sample of the texts: at most ``most`` words of ``BROADCAST_BYTES`` bytes."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    counts = docs.filter(chance).select("text").mapInArrow(count_words, "word string, n long")
    counts = cut(counts.groupBy("word").agg(F.sum("n").alias("n")))
    chosen = counts.filter(F.col("n") >= threshold_for(counts, "n", most)).select("word", F.col("word").alias("known"))
    rows = chosen.mapInArrow(encode_words(path), "known string, ids binary").toArrow()
    own = tokenizer(path)
    kind = "<u2" if own.get_vocab_size(with_added_tokens=True) < 65_535 else "<u4"
    special = tuple(t.content.encode() for t in own.get_added_tokens_decoder().values())
    return Table(rows["known"].cast(pa.binary()).to_pylist(), rows["ids"].to_pylist(), kind, special)


def pieces(path: str) -> list[bytes]:
    """The bytes of every id: the id-to-piece table of a byte-level vocabulary."""
    loaded = tokenizer(path)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]          # bytes that are written as themselves
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {i: token.content for i, token in loaded.get_added_tokens_decoder().items()}
    vocabulary = {i: piece for piece, i in loaded.get_vocab(with_added_tokens=True).items()}
    return [
        added[i].encode() if i in added else bytes(byte_of[c] for c in vocabulary[i]) if i in vocabulary else b""
        for i in range(max(vocabulary) + 1)
    ]


def decode(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def chunk_key(doc_ids: pa.Array, data: list[bytes]) -> int:
    """Names a chunk by its ids and texts, so that both passes over the texts name it alike."""
    digest = hashlib.blake2b(repr(doc_ids.to_pylist()).encode(), digest_size=8)
    for text in data:
        digest.update(text)
        digest.update(b"\xff")
    return int.from_bytes(digest.digest(), "little", signed=True)


def encode(docs: DataFrame, path: str, most: int = BROADCAST_WORDS) -> DataFrame:
    """(doc_id, ids: binary of little-endian unsigned 32-bit ids) of every row.

    The ids are those of the tokenizer for the whole text.  A null or empty
    text has none; repeated rows get equal ids.  Texts are handled in chunks of
    about ``CHUNK`` bytes (or one longer text), in two passes, so ``docs`` has to be read in the
    same order twice, as files are; a difference raises an error.
    """
    rows = texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(rows, path, most))

    def missing(batches):
        for batch in batches:
            for low, high, data in chunks(batch["text"], CHUNK):
                key = chunk_key(batch["doc_id"].slice(low, high - low), data)
                found = words(data, shared.value.special)
                lost = np.flatnonzero(~shared.value.look_up(found)[1])
                lost_words = pa.array([found.word(i) for i in lost.tolist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lost), key)), pa.array(np.arange(len(lost), dtype=np.int32)), lost_words], ["chunk", "position", "word"]
                )

    def gapped(batches):
        squeeze = zstandard.ZstdCompressor(level=9)
        for batch in batches:
            for low, high, data in chunks(batch["text"], CHUNK):
                own = batch["doc_id"].slice(low, high - low)
                ids, first = shared.value.gapped(words(data, shared.value.special))
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk_key(own, data)]), pa.array([own.to_pylist()], pa.list_(pa.int64())),
                    pa.array([first.tolist()], pa.list_(pa.int64())), pa.array([squeeze.compress(ids.tobytes())], pa.binary()),
                ], ["chunk", "doc_ids", "first", "held"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lost = rows.mapInArrow(missing, "chunk long, position int, word string").repartition(parts, "word")
    patches = lost.mapInArrow(encode_words(path, shared.value.kind), "chunk long, position int, ids binary")
    held = rows.mapInArrow(gapped, "chunk long, doc_ids array<long>, first array<long>, held binary")
    kind, gap = shared.value.kind, shared.value.gap

    def fill(held: pa.Table, patches: pa.Table) -> pa.Table:
        order = np.unique(patches["position"].to_numpy(), return_index=True)[1]      # equal chunks bring their words each
        new = patches["ids"].take(pa.array(order)).to_pylist()
        doc_ids, out = [], []
        for own_ids, first, squeezed in zip(*(held[c].to_pylist() for c in ("doc_ids", "first", "held"))):
            own = np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed, max_output_size=1 << 31), kind)
            at = np.flatnonzero(own == gap)
            if len(at) != len(new):
                raise RuntimeError("the texts came in another order in the second pass; write the table before encoding it")
            size = np.ones(len(own), np.int64)
            size[at] = np.fromiter(map(len, new), np.int64, len(new)) // np.dtype(kind).itemsize
            ends = np.concatenate(([0], np.cumsum(size)))
            whole = np.empty(int(ends[-1]), "<u4")
            whole[ends[:-1][own != gap]] = own[own != gap]
            filled = np.repeat(own == gap, size)
            whole[filled] = np.frombuffer(b"".join(new), kind)
            cuts = ends[np.array(first)]
            doc_ids += own_ids
            out += [whole[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(out, pa.binary())})

    return held.groupBy("chunk").cogroup(patches.groupBy("chunk")).applyInArrow(fill, "doc_id long, ids binary")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded rows, decoded through the id-to-piece table."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(path))

    def run(batches):
        for batch in batches:
            out = []
            for ids in batch["ids"].to_pylist():
                text = decode(np.frombuffer(ids, "<u4"), table.value)
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
