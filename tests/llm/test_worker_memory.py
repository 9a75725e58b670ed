"""What a Python worker holds while it labels texts, and after a task."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from inkgraph.llm import language, packing, toxicity


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(n))


def test_a_task_leaves_few_encoded_words_in_its_worker(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_BETWEEN", 1_000)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    rows = pa.record_batch({"doc_id": pa.array([1, 2, 3]), "text": pa.array([words(rng, 4_000), words(rng, 20), None])})
    run = packing._cutter(path, 4_096, 2)
    first = pa.Table.from_batches(run([rows])).to_pylist()
    held = packing.encoder(path)
    assert len(held) <= 1_000 and len(held.parts) <= 1_000
    assert pa.Table.from_batches(run([rows])).to_pylist() == first      # ids do not depend on what was kept


def test_long_pieces_are_not_kept():
    enc = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    ids = enc.encode("a" * 5_000 + " b")
    assert max(map(len, enc)) <= 64 and max(map(len, enc.parts)) <= 64
    assert enc.encode("a" * 5_000 + " b") == ids


def test_language_holds_little_beside_the_text():
    """One chunk of 4 MB, and the same texts in one chunk or alone."""
    rng = random.Random(6)
    vocabulary = words(rng, 20_000).split()
    data = [" ".join(rng.choices(vocabulary, k=700)).encode() for _ in range(1_000)]
    data[3], data[7] = b"", b"12 . 4"
    field = language.fit([(" ".join(vocabulary[i::2][:3_000]), f"l{i}") for i in range(2)])
    tracemalloc.start()
    labels, scores = language.predict(field, data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 * sum(map(len, data))
    assert [labels[i] for i in (3, 7)] == ["und", "und"] and set(labels) > {"und"}
    alone = [language.predict(field, [text]) for text in data[:10]]
    assert labels[:10] == [one[0] for one, _ in alone]
    assert scores[:10] == pytest.approx([one[0] for _, one in alone], abs=1e-5)
    assert language.predict(field, [b"", b" "])[0] == ["und", "und"] and len(language.lettered(language.split([]))) == 0
    assert np.array_equal(language.lettered(language.split([b"1 a2  .. \xc3\xa4"])), [1, 3])


def test_toxicity_holds_little_beside_the_text():
    """Text of new words only, whose n-grams are found some at a time; scores are those of the texts alone."""
    rng = random.Random(8)
    data = [words(rng, 700).encode() for _ in range(400)]
    model = toxicity.Model(np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS), 0.1, 1.0, 0.0)
    tracemalloc.start()
    scores = model.scores(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(map(len, data))
    assert scores[:5] == pytest.approx([model.scores([text])[0] for text in data[:5]], abs=1e-9)
