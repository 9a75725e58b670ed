"""Matching over all terms: the term-partitioned index with max-score skipping against every cosine."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from inkgraph.functions.text import terms
from inkgraph.operators import matching


def brute(spark, docs, refs, top):
    d = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", terms(F.col("text")).alias("t")).collect()
    r = spark.createDataFrame(refs, "item_id long, text string").select("item_id", terms(F.col("text")).alias("t")).collect()
    texts = {}
    for side, rows in ((0, d), (1, r)):
        for row in rows:
            texts.setdefault((side, row[0]), []).extend(row["t"])
    n = len(docs) + len(refs)
    df = {}
    for ts in texts.values():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    unit = {}
    for key, ts in texts.items():
        raw = {t: (1 + math.log(ts.count(t))) * (math.log((1 + n) / (1 + df[t])) + 1) for t in set(ts)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        unit[key] = {t: v / norm for t, v in raw.items()}
    out = set()
    for (side, doc), u in unit.items():
        if side or doc is None:
            continue
        sims = []
        for (rside, ref), v in unit.items():
            if rside and ref is not None:
                s = round(sum(w * v.get(t, 0.0) for t, w in u.items()), 6)
                if s > 0:
                    sims.append((-s, ref))
        for rank, (s, ref) in enumerate(sorted(sims)[:top], 1):
            out.add((doc, rank, ref, -s))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    common = ["the", "and", "of", "to"]
    rare = [f"zz{i}" for i in range(300)]
    refs = [(i, " ".join(rng.choice(common + rare[i * 10:i * 10 + 10]) for _ in range(30))) for i in range(25)]
    refs += [(99, None), (98, "the the the"), (None, "zz1 zz2")]
    docs = [(i, " ".join(rng.choice(common * 5 + rare) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    docs += [(500, refs[3][1]), (501, refs[3][1]), (502, None), (503, ""), (None, "zz5 zz6"), (7, "zz11 zz12 zz13")]
    return docs, refs


@pytest.mark.parametrize("block_entries", [matching.BLOCK_ENTRIES, 60])
def test_against_every_cosine(spark, tables, block_entries):
    docs, refs = tables
    d = spark.createDataFrame(docs, "doc_id long, text string")
    r = spark.createDataFrame(refs, "item_id long, text string")
    got = matching.top_matches(d, "doc_id", r, "item_id", top=3, block_entries=block_entries, block_docs=40).collect()
    mine = {(row.doc_id, row.rank, row.item_id, row.similarity) for row in got}
    want = brute(spark, docs, refs, 3)
    assert {k[:3] for k in mine} == {k[:3] for k in want}
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(sorted(mine), sorted(want)))


def test_lists_are_skipped():
    rng = np.random.default_rng(0)
    rows = []
    for ref in range(200):
        for term in rng.choice(1000, 40, replace=False):
            rows.append((ref, int(term), float(rng.random())))
    refs = pd.DataFrame(rows, columns=["ref", "idx", "weight"])
    index = matching.Index(refs)
    idx = np.unique(rng.choice(1000, 300))
    w = rng.random(len(idx))
    ids, sims, read = index.best(idx, w, 3)
    dense = np.zeros((200, 1000))
    dense[refs["ref"], refs["idx"]] = refs["weight"]
    full = np.round(dense[:, idx] @ w, 6)
    order = np.lexsort((np.arange(200), -full))[:3]
    assert ids.tolist() == order.tolist() and np.allclose(sims, full[order])
    assert read < len(idx)


def test_terms_travel_as_hashes(spark, tables):
    """Equal terms have equal hashes in every batch, different ones differ; a null key and repeated keys are counted in."""
    docs, refs = tables
    both = spark.createDataFrame([(0, *row) for row in docs] + [(1, *row) for row in refs], "side int, id long, text string")
    wanted = both.select("side", "id", F.explode(terms(F.col("text"))).alias("term")).groupBy("side", "id", "term").count().collect()
    hashed = matching.term_hashes(both.repartition(5), True)
    assert dict(hashed.dtypes)["term"] == "bigint"
    got = hashed.collect()
    key = lambda r: (r["side"], -1 if r["id"] is None else r["id"])
    assert sorted((*key(r), r["count"]) for r in wanted) == sorted((*key(r), r["tf"]) for r in got)
    df = lambda rows: sorted(pd.Series([r["term"] for r in rows]).value_counts().tolist())
    assert df(wanted) == df(got)
