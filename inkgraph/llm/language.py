"""Language of texts by a linear-chain conditional random field over their words.

Every word gets a score per language from hashed n-grams (those at its edges
are its affixes) and from a lexicon of words frequent in the training sample;
learned transitions link neighbouring words.  Forward-backward gives each word
its posterior; the text's language is the one with the largest mean posterior,
so that code-switched texts are judged by all of their words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.llm.common import release_memory, schema_of, texts
from inkgraph.llm.hashed_words import Words, chunks, split
from inkgraph.llm.subwords import buckets

UNDETERMINED = "und"
GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 16
LEXICON = 4_000           # words of the lexicon, at most
SAMPLE_DOCS = 3_000       # labelled texts the classifier is fitted on, at most (in expectation), shared by the languages
SAMPLE_WORDS = 120        # neighbouring words taken from each of them, from a place given by the text's hash
SEGMENT = 12              # mean words between two switches in training sequences
LENGTH = 60
EPOCHS = 4
CHUNK = 8 << 20           # bytes of text labelled at a time
TOGETHER = 10_000         # words whose n-grams are found at a time
IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = True
IS_LETTER[128:] = True


@dataclass
class Field:
    """The fitted field: languages, weights (bucket or lexicon entry x language), transitions."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Words, chosen: np.ndarray) -> np.ndarray:
        """One row of language scores for each chosen word; equal words are computed once."""
        keys, one, back = np.unique(words.hash[chosen], return_index=True, return_inverse=True)
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        for low in range(0, len(keys), TOGETHER):
            some = slice(low, low + TOGETHER)
            ids, first = buckets(words, chosen[one[some]], GRAMS, BUCKETS)
            out[some] = np.add.reduceat(self.weights[ids], first[:-1], axis=0)
            out[some] /= np.sqrt(np.diff(first), dtype=np.float32)[:, None]
        entry, known = lexicon_entries(self.lexicon, keys)
        out[known] += self.lexicon_weights[entry[known]]
        return out[back]


def lexicon_entries(lexicon: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(lexicon):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
    return place, lexicon[place] == keys


def lettered(words: Words) -> np.ndarray:
    """Words with an ASCII letter or a byte beyond ASCII."""
    if not len(words.start):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.logical_or.reduceat(IS_LETTER[words.data], words.start))      # what parts words holds no letter


def forward_backward(emissions: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posteriors of all words, one row each; sequence i has rows ``first[i]:first[i + 1]``.

    Sequences are sorted by length and advanced together, one word a step; the
    rows of one step lie side by side.
    """
    length = np.diff(first)
    rank = np.empty(len(length), np.int64)
    rank[np.argsort(-length, kind="stable")] = np.arange(len(length))
    longest = int(length.max()) if len(length) else 0
    active = len(length) - np.cumsum(np.bincount(length, minlength=longest + 1))[:longest]
    step = np.concatenate(([0], np.cumsum(active)))
    place = step[np.arange(len(emissions)) - np.repeat(first[:-1], length)] + np.repeat(rank, length)
    local = np.empty(emissions.shape, emissions.dtype)
    local[place] = np.exp(emissions - emissions.max(axis=1, keepdims=True)) if len(emissions) else emissions
    move = np.exp(transitions).astype(emissions.dtype)
    ones = np.ones(move.shape[0], emissions.dtype)
    alpha = np.empty_like(local)
    now = None
    for t, n in enumerate(active):
        now = local[step[t]: step[t + 1]] if t == 0 else (now[:n] @ move) * local[step[t]: step[t + 1]]
        now = now / (now @ ones)[:, None]
        alpha[step[t]: step[t + 1]] = now
    beta = np.ones((len(length), local.shape[1]), emissions.dtype)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        part = slice(step[t], step[t + 1])
        alpha[part] *= beta[:n]
        back = (beta[:n] * local[part]) @ move.T
        beta[:n] = back / (back @ ones)[:, None]
    alpha /= (alpha @ ones)[:, None]
    return alpha[place]


def sample(docs: DataFrame, train: Column) -> list[tuple[str, str]]:
    """(window of words, language) of about ``SAMPLE_DOCS`` training rows, chosen by a hash of id and text."""
    rows = texts(docs, "lang", train.alias("train")).filter(F.col("train") & F.col("lang").isNotNull())
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(SAMPLE_DOCS / len(counts) / n)).otherwise(share)
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    words = F.split(F.trim("text"), r"[ \t\n\x0B\f\r]+")
    room = F.greatest(F.size("words") - SAMPLE_WORDS, F.lit(0)) + 1
    picked = rows.filter(chance < share).select("lang", words.alias("words"), F.xxhash64("text").alias("at"))
    window = F.slice("words", (F.pmod("at", room) + 1).cast("int"), SAMPLE_WORDS)
    return sorted((r.text, r.lang) for r in picked.select("lang", F.array_join(window, " ").alias("text")).collect())


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Field | None:
    """Maximum likelihood (AdaGrad) over sequences in which the language switches now and then."""
    if not rows:
        return None
    languages = sorted({lang for _, lang in rows})
    n_lang, rng = len(languages), np.random.default_rng(seed)
    words = split([text.encode() for text, _ in rows])
    label = np.repeat([languages.index(lang) for _, lang in rows], np.diff(words.first))
    use = lettered(words)
    if not len(use):
        return None
    keys, one, back, count = np.unique(words.hash[use], return_index=True, return_inverse=True, return_counts=True)
    ids, first = buckets(words, use[one], GRAMS, BUCKETS)
    frequent = np.argsort(-count, kind="stable")[:LEXICON]
    lexicon = np.sort(keys[frequent[count[frequent] >= 3]])
    entry, known = lexicon_entries(lexicon, keys)

    # Segments of neighbouring words, shuffled: sequences of many languages.
    label, text_of = label[use], np.searchsorted(words.first, use, side="right")
    cuts = (rng.random(len(use)) < 1 / SEGMENT) | np.concatenate(([True], text_of[1:] != text_of[:-1]))
    segment = np.cumsum(cuts) - 1
    order = np.argsort(rng.permutation(segment[-1] + 1)[segment], kind="stable")
    word_at, label_at = back[order], label[order]

    weights, lex_weights = np.zeros((BUCKETS, n_lang)), np.zeros((len(lexicon), n_lang))
    moves = np.zeros((n_lang, n_lang))
    squares = [np.full_like(w, 1e-6) for w in (weights, lex_weights, moves)]
    scale = 1 / np.sqrt(np.diff(first))
    batch = 64 * LENGTH
    for _ in range(EPOCHS):
        for low in rng.permutation(np.arange(0, len(word_at), batch)):
            some, want = word_at[low: low + batch], label_at[low: low + batch]
            at = np.concatenate((np.arange(0, len(some), LENGTH), [len(some)]))
            types, here = np.unique(some, return_inverse=True)
            spans = np.diff(first)[types]
            flat = np.repeat(first[types], spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            gram, owner = ids[flat], np.repeat(np.arange(len(types)), spans)
            emit = np.add.reduceat(weights[gram], np.cumsum(spans) - spans, axis=0) * scale[types][:, None]
            has = known[types]
            emit[has] += lex_weights[entry[types[has]]]
            posterior = forward_backward(emit[here], at, moves)
            error = np.zeros((len(types), n_lang))
            np.add.at(error, here, np.eye(n_lang)[want] - posterior)
            inner = np.setdiff1d(np.arange(1, len(some)), at)
            step = posterior[inner - 1][:, :, None] * np.exp(moves)[None] * posterior[inner][:, None, :]
            step /= step.sum(axis=(1, 2), keepdims=True)
            move_error = np.zeros_like(moves)
            np.add.at(move_error, (want[inner - 1], want[inner]), 1.0)
            move_error -= step.sum(axis=0)
            spread = error * scale[types][:, None]
            gram_error = np.zeros_like(weights)
            for c in range(n_lang):
                gram_error[:, c] = np.bincount(gram, spread[owner, c], BUCKETS)
            lex_error = np.zeros_like(lex_weights)
            np.add.at(lex_error, entry[types[has]], error[has])
            for w, g, s in zip((weights, lex_weights, moves), (gram_error, lex_error, move_error), squares):
                g = g - 1e-3 * w
                s += g * g
                w += 0.3 * g / np.sqrt(s)
    return Field(languages, weights.astype(np.float32), lexicon, lex_weights.astype(np.float32), moves)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(field: Field | None, data: list[bytes]) -> tuple[list[str], np.ndarray]:
    """(language, mean posterior) of each text."""
    languages, scores = [UNDETERMINED] * len(data), np.zeros(len(data))
    if field is None:
        return languages, scores
    words = split(data)
    use = lettered(words)
    first = np.searchsorted(use, words.first)
    posterior = forward_backward(field.emissions(words, use), first, field.transitions)
    worded = np.flatnonzero(np.diff(first) > 0)
    total = np.add.reduceat(posterior, first[worded], axis=0, dtype=float) if len(worded) else []
    for i, sums in zip(worded, total):
        if has_letter(data[i][:64]) or has_letter(data[i]):
            best = int(np.argmax(sums))
            languages[i] = field.languages[best]
            scores[i] = min(1.0, max(0.0, sums[best] / (first[i + 1] - first[i])))
    return languages, scores


def identify(docs: DataFrame, train: Column, *keep: str) -> DataFrame:
    """(doc_id, keep..., lang_pred, score) of every row, learned from the rows where ``train`` holds.

    A null or empty text, or one without letters, is ``und`` with score 0, and
    so is every text if there is no labelled row to learn from.  Ties go to the
    language that sorts first; repeated rows get equal results.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit(sample(docs, train)))
    release_memory()
    rows = texts(docs, *keep)

    def run(batches):
        for batch in batches:
            for low, high, data in chunks(batch["text"], CHUNK):
                languages, scores = predict(field.value, data)
                own = [batch[c].slice(low, high - low) for c in ("doc_id", *keep)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(languages, pa.string()), pa.array(scores)], names)
        release_memory()

    names = ["doc_id", *keep, "lang_pred", "score"]
    return rows.mapInArrow(run, schema_of(rows, "doc_id", *keep) + "lang_pred string, score double")
