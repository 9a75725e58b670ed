"""NRA search against scores computed for every document."""

import math
import random
import re

import pytest

from inkgraph.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall((text or "").translate(str.maketrans(lexical_search.UPPER, lexical_search.LOWER)))


def brute(docs, items, k):
    t = [words(text) for _, text in docs]
    n_docs, n_terms = sum(1 for x in t if x), sum(len(x) for x in t)
    df = {}
    for x in t:
        for term in set(x):
            df[term] = df.get(term, 0) + 1
    terms_of = {}
    for item_id, text in items:
        terms_of.setdefault(item_id, set()).update(words(text))
    out = set()
    for item_id, its in terms_of.items():
        scores = []
        for (doc_id, _), x in zip(docs, t):
            if not x:
                continue
            m = 50 + (50 * len(x) * n_docs) // n_terms
            s = 0
            for term in its:
                tf = x.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[term] + 1)))
                    s += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, s, doc_id))
        scores.sort(key=lambda r: r[:3])
        out |= {(item_id, rank, r[4], r[3]) for rank, r in enumerate(scores[:k], 1)}
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "x9"]
    docs = [(i, " ".join(rng.choice(vocab[: 10 + i % 50]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    docs += [(None, "w1 w2 w3 w3"), (5, docs[5][1]), (500, None), (501, ""), (502, "w59 " * 3000), (503, "W1,w1;W1"),
             (504, docs[7][1]), (None, docs[7][1])]
    items = [(1, "w1 w2 w3"), (2, "w55 w59 straße"), (2, "ÉTÉ"), (3, "nothing here"), (None, "w3 w4"), (4, None), (5, "w40 x9 w1")]
    return docs, items


@pytest.mark.parametrize("k", [1, 3, 50])
def test_against_brute_force(spark, tables, k):
    docs, items = tables
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", lexical_search.F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", lexical_search.F.lit("x"))
    got = lexical_search.search(d, b, k).collect()
    assert {(r.item_id, r.rank, r.doc_id, r.score) for r in got} == brute(docs, items, k)
    assert len(got) == len(brute(docs, items, k))
    if k == 1:
        assert min(r.rounds for r in got) < max(r.rounds for r in got)   # some items stop before the last level


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.search(d, b).collect() == []
    assert lexical_search.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"),
                                 spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_rounds_that_settle_no_item_read_their_postings_once(spark, monkeypatch):
    """Items of many terms need the last level: no round before it looks for challengers, and the last sums no bounds."""
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(vocab, k=30))) for i in range(80)]
    items = [(i, " ".join(rng.sample(vocab, 30))) for i in range(3)]
    joined, plain = [], lexical_search._small
    monkeypatch.setattr(lexical_search, "_small", lambda df: joined.append(df.columns) or plain(df))
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5).collect()
    assert {(r.item_id, r.rank, r.doc_id, r.score) for r in got} == brute(docs, items, 5)
    assert {r.rounds for r in got} == {len(lexical_search.LEVELS) + 1}
    assert not any("kth" in columns for columns in joined)
    assert sum("rest" in columns for columns in joined) == len(lexical_search.LEVELS)
