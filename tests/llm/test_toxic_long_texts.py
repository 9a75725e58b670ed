"""Toxicity of long texts with a single insult."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from inkgraph.llm import hashed_words, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, n_words):
    rng, rows, labels = random.Random(8), [], []
    for i in range(300):
        text = [f"w{rng.randrange(400)}" for _ in range(n_words)]
        if i % 3 == 0:
            text[rng.randrange(n_words)] = rng.choice(["grobnix", "schlumpf"])
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, int(i % 3 == 0)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_training_texts_are_whole_and_bounded_together(spark, monkeypatch):
    docs, labels = tables(spark, 4_000)
    rows, prior = toxicity.sample(docs, labels, F.lit(True))
    assert len(rows) == 300 and abs(prior - 1 / 3) < 1e-9
    assert all(len(t.split()) == 4_000 and y == ("grobnix" in t or "schlumpf" in t) for t, y in rows)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 20 * len(rows[0][0]))
    few, same = toxicity.sample(docs, labels, F.lit(True))
    assert same == prior and set(few) < set(rows) and all(5 <= sum(y == k for _, y in few) <= 40 for k in (0, 1))


def test_long_texts_are_told_apart(spark):
    docs, labels = tables(spark, 4_000)
    model = toxicity.learn(docs, labels, F.col("doc_id") < 240)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).filter("doc_id >= 240").collect()}
    assert np.mean([got[i] == (i % 3 == 0) for i in got]) > 0.95

def test_training_holds_words_as_small_numbers():
    """The driver trains within its memory: a word of a training text costs a few bytes, whatever the temporaries."""
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(3_000)]
    rows = [(" ".join(rng.choice(plain, 4_000)) + (" awful" if i % 2 else ""), i % 2) for i in range(400)]
    n_words = 400 * 4_000
    hashed_words.powers(1)       # kept tables are not counted
    tracemalloc.start()
    try:
        model = toxicity.fit(rows, 0.5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.scores([b"w1 awful w2"])[0] > model.scores([b"w1 w2 w3"])[0]
    assert peak < 50 * n_words


def test_windows_found_in_parts_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(6)
    data = [" ".join(f"w{w}" for w in rng.integers(0, 50, n)).encode() for n in rng.integers(0, 90, 120)] + [b""]
    label = np.arange(len(data)) % 2
    whole = toxicity.numbered(data, label)
    monkeypatch.setattr(toxicity, "PART_BYTES", 700)
    monkeypatch.setattr(toxicity, "PART_WORDS", 300)
    parts = toxicity.numbered(data, label)
    split = hashed_words.split(data)
    keys, back = np.unique(split.hash, return_inverse=True)
    score = rng.normal(size=len(keys))
    for found in (whole, parts):
        of = np.empty(len(found.gram_first) - 1)
        of[found.word] = score[back]
        for mine, plain in zip(found.worst(of), toxicity.worst(score[back], split.first)):
            assert mine.tolist() == plain.tolist()
        for y in (0, 1):
            holds = [{w for w in data[i].split()} for i in range(len(data)) if label[i] == y]
            assert sorted(found.seen[y]) == sorted(sum(w in h for h in holds) for w in {w for d in data for w in d.split()})
