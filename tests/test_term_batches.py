"""Terms counted and numbered a batch of texts at a time."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa

from inkgraph.operators import term_batches, tfidf

TEXTS = ["red car red car fast", None, "", "a red b car", "É été car, RED car", "fast fast fast", "x y z", "red car red car fast"]


def _tokens(text):
    return [w for w in (text or "").lower().replace(",", " ").split() if len(w) > 1]


def _terms(text):
    words = _tokens(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_counts_and_rows_come_from_one_look(spark):
    """Occurrences and rows per term by brute force; before, the texts were tokenized once more for the rows."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)
    n = Counter(t for text in TEXTS for t in _terms(text))
    df = Counter(t for text in TEXTS for t in set(_terms(text)))
    got = {r["term"]: (r["n"], r["df"]) for r in tfidf.term_counts(docs, "text").collect()}
    assert got == {t: (n[t], df[t]) for t in n}
    model = tfidf.fit(docs, "text", 6)
    wanted = sorted(sorted(n, key=lambda t: (-n[t], t))[:6])
    assert (model.terms, model.df, model.n_docs) == (wanted, [df[t] for t in wanted], len(TEXTS))


def test_sparse_rows_by_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(2)
    model = tfidf.fit(docs, "text", 5)
    rows = {r["id"]: r for r in model.vectors(model.transform(docs, "text"), "text").collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        tf = Counter(t for t in _terms(text) if t in model.terms)
        raw = {model.terms.index(t): (1 + math.log(c)) * model.idf[model.terms.index(t)] for t, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        assert list(rows[i]["indices"]) == sorted(raw) == list(rows[i]["features"].indices)
        assert np.allclose(rows[i]["weights"], [raw[j] / norm for j in sorted(raw)])
        assert np.allclose(rows[i]["features"].values, rows[i]["weights"]) and rows[i]["features"].size == 5
    assert not any(x in model.vectors(docs, "text")._jdf.queryExecution().toString() for x in ("BatchEvalPython", "to_sparse"))


def test_slices_lose_no_row_and_large_codes_are_counted():
    lists = pa.array([["aa"], [], None, ["bb", "cc"], ["aa"] * 5, []], pa.list_(pa.string()))
    parts = list(term_batches.slices(lists, 2))
    assert [x for p in parts for x in p.to_pylist()] == lists.to_pylist()
    assert len(parts) > 1
    code, row, n = term_batches.occurrences(np.array([1 << 61, 5, 1 << 61, 1 << 61]), np.array([0, 1, 3, 3]), 4)
    assert (code.tolist(), row.tolist(), n.tolist()) == ([5, 1 << 61, 1 << 61], [1, 0, 3], [1, 1, 2])
