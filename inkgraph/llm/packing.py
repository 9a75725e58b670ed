"""Packing of documents into windows by a non-negative least-squares plan over the histogram of lengths.

Documents are cut at window borders only; what is left of each (its tail) is
packed.  Shallow combinations of (rounded) tail lengths that fill a window are
enumerated; non-negative least squares finds how often to use each so that the
histogram is met; the counts are rounded down and the lengths left over are
packed greedily, largest first.  The plan needs one number per length, so it is
made on the driver whatever the number of documents; documents find their place
in it by their number among those of equal length.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from inkgraph.llm.common import release_memory, texts
from inkgraph.llm.hashed_words import chunks
from inkgraph.session import cut

WINDOW = 4_096
STEP = 16                # tail lengths are rounded up to multiples of this in the plan
DEPTH = 3                # different parts of a combination
END = 2                  # id that closes a document
KEPT_WORDS = 500_000     # encoded words kept by a worker within a task
KEPT_BETWEEN = 100_000   # and from one task for the next, which may be of another stage
KEPT_LENGTH = 64         # of the longest words and pieces kept
CHUNK = 8 << 20          # bytes of text encoded at a time
NO_ID = 0xFFFFFFFF
TOGETHER = 100           # pieces encoded in one call
GROUP = 20_000           # tails numbered together, in expectation

# The pattern by which the tokenizer cuts a text into pieces, and the same for lower-case ASCII and Latin-1 letters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-zß-öø-ÿ0-9\x20\t-\r]+")
# The characters that byte-level models have for the bytes they do not show as themselves; a line feed only parts pieces.
HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
SHOWN = {b: 256 + i for i, b in enumerate(HIDDEN) if b != 10}
LATIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]+")


class WordEncoder(dict):
    """Ids (as little-endian bytes) by word, for a tokenizer that drops white space; filled as words are met.

    ``parts`` has the ids of the pieces in which the tokenizer itself takes a
    Latin word (runs of letters, of signs, single digits): far fewer than words.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_like = re.compile("|".join(re.escape(s.lower()) for s in self.specials) or r"(?!)").search
        self.fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        model = Tokenizer(self.tokenizer.model)
        model.pre_tokenizer = WhitespaceSplit()
        self.model_batch = model.encode_batch      # the fast one numbers no pieces
        self.apart = SPLIT in str(self.tokenizer.pre_tokenizer)      # else words are left to the tokenizer whole
        self.parts: dict[str, bytes] = {"\n": np.array([NO_ID], "<u4").tobytes()}
        self[""] = b""

    def words(self, text: str) -> list[str]:
        """White space separates words before anything else.  The tokenizer drops case itself; lower-casing an
        ASCII text first makes fewer distinct words, unless that would turn text into a special token."""
        text = text.replace("\n", " ")
        if text.isascii():
            low = text.lower()
            if low == text or all(low.count(s) == text.count(s) for s in self.specials):
                text = low
        return text.split(" ")

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces in lower case by the tokenizer's model: many at once, told apart by their number."""
        out = []
        for low in range(0, len(pieces), TOGETHER):
            some = pieces[low: low + TOGETHER]
            shown = " ".join(some)
            if not (shown.isascii() and shown.isprintable()):
                shown = shown.encode().replace(b" ", b"\n").decode("latin-1").translate(SHOWN)
            done = self.model_batch([shown], add_special_tokens=False)[0]
            number, ids = np.array(done.word_ids, np.int64), np.array(done.ids, "<u4").tobytes()
            edge = (4 * np.searchsorted(number, np.arange(len(some) + 1))).tolist()
            out += [ids[a:b] for a, b in zip(edge, edge[1:])]
        return out

    def learn(self, words: set[str]) -> None:
        """Ids of new words.  Words of ASCII and Latin-1 letters are taken as the tokenizer's pieces of them; others, and those like a special token, whole."""
        latin = [w for w in words if w.isascii() or LATIN.fullmatch(w)] if self.apart else []
        low = "\n".join(latin).lower()
        if self.special_like(low):
            latin = [w for w in latin if not self.special_like(w.lower())]
            low = "\n".join(latin).lower()
        whole = sorted(words.difference(latin))
        self.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(whole, self.fast(whole, add_special_tokens=False)))
        pieces = PIECES.findall(low)      # a line feed, as a piece, parts words
        fresh = sorted(set(pieces) - self.parts.keys(), key=str.isascii)      # those in ASCII need no other characters
        self.parts.update(zip(fresh, self.encode_pieces(fresh)))
        ids = np.frombuffer(b"".join(map(self.parts.__getitem__, pieces)), "<u4")
        ends = (4 * np.flatnonzero(ids == NO_ID)).tolist() + [4 * len(ids)]
        data, start = ids.tobytes(), 0
        for w, end in zip(latin, ends):
            self[w] = data[start:end]
            start = end + 4
        for p in fresh:
            if len(p) > KEPT_LENGTH:
                del self.parts[p]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the pieces of words not met before are encoded together."""
        split = [self.words(t) for t in texts]
        found = [list(map(self.get, ws)) for ws in split]
        unknown = [i for i, ids in enumerate(found) if None in ids]
        words = {w for i in unknown for w, ids in zip(split[i], found[i]) if ids is None}
        if words:
            self.learn(words)
            for i in unknown:
                found[i] = map(self.__getitem__, split[i])
        done = [b"".join(ids) for ids in found]
        for w in words:
            if len(w) > KEPT_LENGTH:
                del self[w]
        self.forget(KEPT_WORDS)
        return done

    def forget(self, most: int) -> None:
        """All words go if they are more than ``most``, and so do all pieces."""
        if len(self) > most:
            self.clear()
            self[""] = b""
        if len(self.parts) > most:
            self.parts = {"\n": self.parts["\n"]}

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _cutter(path: str, window: int, end: int):
    closing = np.array([end], "<u4").tobytes()

    def run(batches):
        encode_many = encoder(path).encode_many
        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            for low, high, data in chunks(batch["text"], CHUNK):
                out = []
                encoded = encode_many([text.decode("utf-8", "replace") for text in data])
                for doc_id, done in zip(doc_ids[low:high], encoded):
                    ids = memoryview(done + closing)
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        part = ids[4 * start: 4 * (start + window)]
                        out.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )
        encoder(path).forget(KEPT_BETWEEN)
        release_memory()      # the worker lives on, in the pipeline with tasks of other stages
    return run


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's full windows, then its tail."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return texts(docs).mapInArrow(_cutter(path, window, end), schema)


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Multisets of whole numbers that sum to ``units``: all of up to ``depth`` parts, and those of one repeated part and one more."""
    found: set[tuple[int, ...]] = {(units,)}
    for a in range(1, units):
        if depth >= 2 and a <= units - a:
            found.add((units - a, a))
        if depth >= 3:
            for b in range(a, (units - a) // 2 + 1):
                found.add((units - a - b, b, a))
    for a in range(1, units // 4 + 1):
        for times in range(4, units // a + 1):
            rest = units - times * a
            if rest not in range(1, a):
                found.add(tuple(sorted((a,) * times + ((rest,) if rest else ()), reverse=True)))
    return sorted(found)


def non_negative(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """min |a x - b| with x >= 0, by active sets: one column enters a round, negative ones leave."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[used] = -np.inf
        enter = int(np.argmax(gain))
        if gain[enter] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        used[enter] = True
        while used.any():
            at = np.flatnonzero(used)
            wish = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (wish > 1e-12).all():
                x[:] = 0
                x[at] = wish
                break
            low = wish <= 1e-12
            share = np.min(x[at][low] / np.maximum(x[at][low] - wish[low], 1e-300))
            x[at] += share * (wish - x[at])
            used[at[low & (x[at] <= 1e-12 * max(1.0, x.max()))]] = False
            if not low.any() or share <= 0:
                used[at[low]] = False
            x[~used] = 0
    return x


def bin_of(length: int, step: int) -> int:
    return -(-length // step)


def plan(histogram: dict[int, int], window: int = WINDOW, step: int = STEP) -> list[tuple[dict[int, int], int]]:
    """[(lengths of one sequence with their repeats, number of such sequences)], using every tail of the histogram once."""
    units = window // step
    bins = [0] * (units + 1)
    for length, n in histogram.items():
        bins[bin_of(length, step)] += n
    total = sum(bins)
    patterns: list[tuple[dict[int, int], int]] = []
    left = +Counter(histogram)
    if total:
        mixes = [m for m in combinations(units) if all(bins[u] >= k for u, k in Counter(m).items())]
        if mixes:
            a = np.zeros((units + 1, len(mixes)))
            for i, m in enumerate(mixes):
                np.add.at(a[:, i], list(m), 1)
            times = non_negative(a, np.array(bins, float), rounds=units)
            by_bin: dict[int, list[int]] = {}
            for length in sorted(left):
                by_bin.setdefault(bin_of(length, step), []).append(length)       # longest of each bin last
            for i in np.argsort(-times, kind="stable"):
                parts = Counter(mixes[i])
                repeats = min([int(times[i])] + [bins[u] // k for u, k in parts.items()])
                for u, k in parts.items():
                    bins[u] -= k * repeats
                patterns += _exact(parts, repeats, by_bin, left, window, step)
    return patterns + greedy(left, window)


def _exact(
    parts: Counter, repeats: int, by_bin: dict[int, list[int]], left: Counter, window: int, step: int
) -> list[tuple[dict[int, int], int]]:
    """Sequences of one rounded combination in terms of true lengths, as many alike as the lengths allow, then the next.

    The smallest part takes the longest length left that fits the room, so
    rounding costs little; a combination whose lengths are used up ends early.
    """
    out, lengths = [], sorted(left)
    units = sorted(parts.elements(), reverse=True)
    while repeats > 0:
        take: Counter = Counter()
        for i, u in enumerate(units):
            room = window - sum(length * k for length, k in take.items())
            if i == len(units) - 1:
                at = bisect_right(lengths, room) - 1
                while at >= 0 and left[lengths[at]] <= take[lengths[at]]:
                    at -= 1
                choice = lengths[at] if at >= 0 else None
            else:
                choice = next((x for x in reversed(by_bin.get(u, [])) if left[x] > take[x]), None)
            if choice is None:
                return out
            take[choice] += 1
        take = +take
        alike = min([repeats] + [left[length] // k for length, k in take.items()])
        for length, k in take.items():
            left[length] -= k * alike
            if not left[length]:
                by_bin[bin_of(length, step)].remove(length)
                lengths.remove(length)
        out.append((dict(take), alike))
        repeats -= alike
    return out


def greedy(left: Counter, window: int) -> list[tuple[dict[int, int], int]]:
    """The longest length left, then always the longest that still fits; a sequence is repeated while its lengths last."""
    out, left = [], +Counter(left)
    lengths = np.array(sorted(left), np.int64)
    alive = np.array([left[int(x)] for x in lengths], np.int64)
    while alive.any():
        take, room = {}, window
        while True:
            fit = np.flatnonzero((lengths <= room) & (alive > 0))
            fit = [i for i in fit[::-1] if take.get(i, 0) < alive[i]][:1] if len(fit) else []
            if not fit:
                break
            i = int(fit[0])
            n = min(room // int(lengths[i]), int(alive[i]) - take.get(i, 0))
            take[i] = take.get(i, 0) + n
            room -= n * int(lengths[i])
        repeats = min(int(alive[i]) // n for i, n in take.items())
        for i, n in take.items():
            alive[i] -= n * repeats
        out.append(({int(lengths[i]): n for i, n in take.items()}, repeats))
    return out


def places(patterns: list[tuple[dict[int, int], int]], first_sequence: int) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, parts of this length per sequence, first slot) by number."""
    out: dict[int, list] = {}
    used: Counter = Counter()
    for parts, repeats in patterns:
        slot = 0
        for length in sorted(parts, reverse=True):
            out.setdefault(length, []).append((used[length], first_sequence, parts[length], slot))
            used[length] += parts[length] * repeats
            slot += parts[length]
        first_sequence += repeats
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone.  Repeated rows are packed each.
    Sequences are numbered from 0 without gaps; none is longer than ``window``.
    """
    cuts = cut(pieces(docs, path, window, end))
    groups = max(1, -(-cuts.count() // GROUP))
    cuts = cuts.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int"))
    counts = cut(cuts.groupBy("length", "part").count())
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    full = histogram.pop(window, 0)
    where = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, window), full))

    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1
    numbered = cuts.withColumn("within", within).join(before, ["length", "part"]).withColumn("number", F.col("within") + F.col("before"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def locate(batches):
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            sequence, slot = number.copy(), np.zeros(len(number), np.int64)      # a full window is a sequence of its own
            for one in np.unique(length[length < window]):
                mine = np.flatnonzero(length == one)
                rows = where.value[int(one)]
                row = rows[np.searchsorted(rows[:, 0], number[mine], side="right") - 1]
                nth = number[mine] - row[:, 0]
                sequence[mine], slot[mine] = row[:, 1] + nth // row[:, 2], row[:, 3] + nth % row[:, 2]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(sequence), pa.array(slot)], [*kept, "sequence_id", "slot"])

    placed = numbered.select(*kept, "number").mapInArrow(locate, ", ".join(f"{c} long" for c in [*kept, "sequence_id", "slot"]))
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*kept, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))
