"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly.

A word's vector is the mean of the embeddings of its character n-grams, so a
misspelt word is close to its origin.  A few neighbouring words are averaged and
classified together; windows cover the whole text and a text is as toxic as
its most toxic window, so that length does not dilute a few words.  Training
alternates: find each labelled text's worst window under the present model,
then take gradient steps on embeddings and softmax for these windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.llm.common import release_memory, schema_of, texts
from inkgraph.llm.hashed_words import Words, chunks, split
from inkgraph.llm.subwords import buckets

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
WIDTH = 8                 # of an embedding
WINDOW, STRIDE = 6, 3     # words averaged together
SAMPLE_DOCS = 4_000       # training texts of each label, at most (in expectation)
SAMPLE_BYTES = 16 << 20   # of all training texts of each label, at most (in expectation): beyond it fewer texts, each of them whole
TOGETHER = 10_000         # words whose n-grams are found at a time, while scoring
PART_BYTES = 2 << 20      # text whose words are told apart at a time, while training
PART_WORDS = 1 << 18      # words whose windows are in work at a time, while training
EPOCHS = 14
RATE = 0.3


@dataclass
class Model:
    """``weights``: per bucket, the embedding times the difference of the two softmax rows."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def word_scores(self, words: Words) -> np.ndarray:
        keys, one, back = np.unique(words.hash, return_index=True, return_inverse=True)
        out = np.zeros(len(keys), np.float32)
        for low in range(0, len(keys), TOGETHER):
            some = slice(low, low + TOGETHER)
            ids, first = buckets(words, one[some], GRAMS, BUCKETS)
            out[some] = np.add.reduceat(self.weights[ids], first[:-1]) / np.diff(first)
        return out[back]

    def scores(self, data: list[bytes]) -> np.ndarray:
        words = split(data)
        margin = worst(self.word_scores(words), words.first)[0] + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first): word ranges of all windows, and where each text's windows begin; a text without words has an empty one."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    at = np.concatenate(([0], np.cumsum(count)))
    begin = np.repeat(first[:-1], count) + STRIDE * (np.arange(at[-1]) - np.repeat(at[:-1], count))
    return begin, np.minimum(begin + WINDOW, np.repeat(first[1:], count)), at


def worst(score: np.ndarray, first: np.ndarray, before: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(largest window mean of each text, that window's begin, its end; ``before`` plus the sum of all scores)."""
    begin, end, at = windows(first)
    sums = np.cumsum(np.concatenate(([before], score)), dtype=float)
    mean = (sums[end] - sums[begin]) / np.maximum(1, end - begin)
    top = np.maximum.reduceat(mean, at[:-1]) if len(at) > 1 else np.zeros(0)
    hit = np.flatnonzero(mean == np.repeat(top, np.diff(at)))
    pick = hit[np.searchsorted(hit, at[:-1])]
    return top, begin[pick], end[pick], float(sums[-1])


@dataclass
class Numbered:
    """The words of many texts as numbers of their vocabulary, four bytes a word; the texts themselves are not held.

    ``word``: of each place; those of text i are ``first[i]:first[i + 1]``.  ``gram``: bucket ids of the
    vocabulary's n-grams, those of word w from ``gram_first[w]`` on.  ``seen``: for labels 0 and 1, the texts that hold each word.
    """

    word: np.ndarray
    first: np.ndarray
    gram: np.ndarray
    gram_first: np.ndarray
    seen: list[np.ndarray]

    def worst(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``worst`` of every text by its words' ``score``, a part of the texts at a time; the running sum goes on from part to part."""
        edges = np.unique(np.searchsorted(self.first, np.append(np.arange(0, self.first[-1], PART_WORDS), self.first[-1])))
        edges = np.unique(np.concatenate(([0], edges, [len(self.first) - 1])))
        out, total = [], 0.0
        for a, b in zip(edges[:-1], edges[1:]):
            low, high = self.first[a], self.first[b]
            top, begin, end, total = worst(score[self.word[low:high]], self.first[a: b + 1] - low, total)
            out.append((top, begin + low, end + low))
        return tuple(np.concatenate(column) for column in zip(*out))

    def means(self, weights: np.ndarray) -> np.ndarray:
        """The mean weight of each vocabulary word's n-grams."""
        out = np.zeros(len(self.gram_first) - 1)
        for low in range(0, len(out), 100_000):
            edge = self.gram_first[low: low + 100_001]
            out[low: low + 100_000] = np.add.reduceat(weights[self.gram[edge[0]: edge[-1]]], edge[:-1] - edge[0]) / np.diff(edge)
        return out


def numbered(data: list[bytes], label: np.ndarray) -> Numbered:
    """Words are numbered in the order in which they are met, about ``PART_BYTES`` of text at a time."""
    known, number = np.zeros(0, np.uint64), np.zeros(0, np.int32)       # hashes met so far, sorted, and their numbers
    word, sizes, gram, gram_sizes = [], [], [], []
    seen = [np.zeros(0, np.int64)] * 2
    ends = np.cumsum([len(text) + 1 for text in data])
    edges = np.unique(np.concatenate(([0], np.searchsorted(ends, np.arange(PART_BYTES, ends[-1], PART_BYTES)), [len(data)])))
    for a, b in zip(edges[:-1], edges[1:]):
        words = split(data[a:b])
        sizes.append(np.diff(words.first))
        keys, one, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(known, keys)
        fresh = np.ones(len(keys), bool)
        inside = at < len(known)
        fresh[inside] = known[at[inside]] != keys[inside]
        own = np.empty(len(keys), np.int32)
        own[~fresh] = number[at[~fresh]]
        own[fresh] = len(known) + np.arange(fresh.sum(), dtype=np.int32)
        for low in range(0, int(fresh.sum()), 50_000):
            ids, first = buckets(words, one[fresh][low: low + 50_000], GRAMS, BUCKETS)
            gram.append(ids.astype(np.int32))
            gram_sizes.append(np.diff(first))
        known, number = np.concatenate((known, keys[fresh])), np.concatenate((number, own[fresh]))
        order = np.argsort(known)
        known, number = known[order], number[order]
        word.append(own[back])
        texts_of = np.unique(back * (b - a) + np.repeat(np.arange(b - a), sizes[-1]))
        holds = label[a:b][texts_of % (b - a)]
        for y in (0, 1):
            seen[y] = np.concatenate((seen[y], np.zeros(len(known) - len(seen[y]), np.int64)))
            seen[y][own] += np.bincount(texts_of[holds == y] // (b - a), minlength=len(keys))
    from_zero = lambda parts: np.concatenate([[0], *parts]).cumsum()
    return Numbered(np.concatenate(word), from_zero(sizes), np.concatenate([np.zeros(0, np.int32), *gram]), from_zero(gram_sizes), seen)


def _sample(docs: DataFrame, labels: DataFrame, train: Column) -> tuple[list[tuple[bytes, int]], float]:
    """As ``sample``, with each text as its UTF-8 bytes, fetched through Arrow (no row objects, no decoded copies)."""
    known = labels.filter(train & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id"))
    known = known.agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        return [], 0.0
    chance = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) / float(1 << 20)
    marked = F.col("toxic") == 1

    def picked(share: dict[int, float]) -> DataFrame:
        few = known.filter(chance < F.when(marked, F.lit(share[1])).otherwise(F.lit(share[0])))
        return texts(docs).join(F.broadcast(few), F.col("doc_id") == F.col("label_id"))     # bounded by SAMPLE_DOCS

    share = {y: SAMPLE_DOCS / counts.get(y, 1) for y in (0, 1)}
    rows = picked(share).groupBy("toxic").agg(F.sum(F.octet_length("text")).alias("size")).collect()
    for r in rows:
        share[r.toxic] = min(share[r.toxic], 1.0) * min(1.0, SAMPLE_BYTES / max(1, r["size"]))
    table = picked(share).select("toxic", F.col("text").cast("binary").alias("text")).toArrow()
    found = list(zip(table.column("text").to_pylist(), table.column("toxic").to_pylist()))
    del table
    release_memory()
    found.sort()      # UTF-8 bytes sort as their code points do
    return found, counts.get(1, 0) / sum(counts.values())


def sample(docs: DataFrame, labels: DataFrame, train: Column) -> tuple[list[tuple[str, int]], float]:
    """``train`` is a condition on the labels' doc_id. (whole text, toxic) of texts of each label, about ``SAMPLE_DOCS`` or ``SAMPLE_BYTES`` at most, and the share of toxic ones among all."""
    rows, prior = _sample(docs, labels, train)
    return [(text.decode("utf-8"), y) for text, y in rows], prior


def fit(rows: list[tuple[str, int]], prior: float, seed: int = 11) -> Model | None:
    """Embeddings and softmax by AdaGrad on each text's worst window, then a logistic calibration to the true share."""
    label = np.array([y for _, y in rows])
    if not len(label) or label.min() == label.max():
        return None
    rng = np.random.default_rng(seed)
    words = numbered([text if isinstance(text, bytes) else text.encode() for text, _ in rows], label)
    del rows        # from here on the words' numbers are enough
    ids, first = words.gram, words.gram_first
    spans = np.diff(first)
    embed = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    soft = rng.normal(0, 0.3, (2, WIDTH)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    squares = [np.full_like(w, 1e-4) for w in (embed, soft, bias)]

    # At first a text's worst window is the one with the words most typical of toxic texts.
    seen = words.seen
    word_score = np.log((seen[1] + 0.5) / (seen[1].sum() + 1)) - np.log((seen[0] + 0.5) / (seen[0].sum() + 1))
    word_score = np.where(seen[0] + seen[1] >= 3, word_score, 0.0)
    for _ in range(EPOCHS):
        _, begin, end = words.worst(word_score)
        for part in np.array_split(rng.permutation(len(label)), max(16, len(label) // 256)):
            size = np.maximum(0, end - begin)[part]
            part, size = part[size > 0], size[size > 0]
            if not len(part):
                continue
            flat = np.repeat(begin[part] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            doc = np.repeat(np.arange(len(part)), size)
            word = words.word[flat]
            n = spans[word]
            gram = ids[np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            share = np.repeat(1 / (n * size[doc]), n).astype(np.float32)
            bag = np.repeat(doc, n)
            edge = np.searchsorted(bag, np.arange(len(part)))
            mean = np.add.reduceat(embed[gram] * share[:, None], edge, axis=0)
            logit = mean @ soft.T + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (np.eye(2, dtype=np.float32)[label[part]] - p)
            to_embed = (error @ soft)[bag] * share[:, None]
            place, row = np.unique(gram, return_inverse=True)
            step = np.stack([np.bincount(row, to_embed[:, c], len(place)) for c in range(WIDTH)], axis=1).astype(np.float32)
            squares[0][place] += step * step
            embed[place] += RATE * step / np.sqrt(squares[0][place])
            for w, g, s in ((soft, error.T @ mean, squares[1]), (bias, error.sum(axis=0), squares[2])):
                s += g * g
                w += RATE * g / np.sqrt(s)
        weights = embed @ (soft[1] - soft[0])
        word_score = words.means(weights)
    model = Model(weights, float(bias[1] - bias[0]), 1.0, 0.0)
    margin = words.worst(word_score)[0] + model.bias
    balance = np.where(label == 1, prior / max(1, label.sum()), (1 - prior) / max(1, (1 - label).sum()))
    model.slope, model.shift = calibrated(margin, label, balance)
    return model


def calibrated(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic regression on one number, lightly regularised (Newton steps)."""
    x = np.stack((margin, np.ones_like(margin)), axis=1)
    w, beta = weight / weight.sum(), np.array([0.5, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (w * (label - p)) - 1e-4 * (beta - np.array([1.0, 0.0]))
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(beta[0], 1e-3)), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, train: Column) -> Model | None:
    model = fit(*_sample(docs, labels, train))
    release_memory()
    return model


def score(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """(doc_id, keep..., score, predicted) of every row.

    A null or empty text is scored by the bias alone; without a model (no rows
    of both labels) every score is 0.  Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = texts(docs, *keep)

    def run(batches):
        for batch in batches:
            for low, high, data in chunks(batch["text"]):
                value = np.zeros(len(data)) if shared.value is None else shared.value.scores(data)
                own = [batch[c].slice(low, high - low) for c in ("doc_id", *keep)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(value), pa.array((value >= 0.5).astype(np.int32))], names)
        release_memory()

    names = ["doc_id", *keep, "score", "predicted"]
    return rows.mapInArrow(run, schema_of(rows, "doc_id", *keep) + "score double, predicted int")
