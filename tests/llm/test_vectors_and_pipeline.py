"""Vector searches against brute force, and the pipeline's decisions."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from inkgraph.llm import multi_index, secret_scan, top_k, vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, n=900, width=24, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)) * rng.lognormal(0, 0.4, (n, 1))
    v[n // 2] = v[3]
    rows = [(i, [float(x) for x in one], 0) for i, one in enumerate(v.astype(np.float32))]
    odd = [(7_000, None, 1), (7_020, [1.0] * (width - 1) + [None], 1), (7_040, [float("nan")] * width, 1), (7_060, [float("inf")] * width, 1),
           (None, [1.0] * width, 1), rows[40], (7_080, [0.0] * width, 1), (7_100, [1.0, 2.0], None), (7_101, [2.0, 2.0], None)]
    clash = spark.createDataFrame([*rows, *odd], VECTORS).withColumn("score", F.lit("x")).withColumn("v", F.lit("y")).withColumn("query_id", F.lit(1))
    return clash, np.array([r[0] for r in rows]), v.astype(np.float32).astype(float)


def best(ids, x, asked, top):
    score = x[asked] @ x.T
    out = {}
    for i, q in enumerate(asked):
        order = [k for k in np.lexsort((ids, -score[i])) if ids[k] != ids[q]][:top]
        out[int(ids[q])] = [(int(ids[k]), score[i][k]) for k in order]
    return out


@pytest.mark.parametrize("block", [16_384, 200])
def test_top_k_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", max(20, block // 8))
    df, ids, x = table(spark)
    whole = np.concatenate((np.floor(64 * x), np.zeros((1, x.shape[1]))))      # the zero vector takes part here
    got = {}
    for r in top_k.top_inner_products(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, float(r.score)))
    want = best(np.append(ids, 7_080), whole, [*range(0, 900, 20), 900], 20) | {7_100: [(7_101, 64.0 * 64 * 6)]}
    assert got == want


def test_nearest_recall_and_scores(spark):
    df, ids, x = table(spark, 3_000)
    got = {}
    for r in multi_index.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = best(ids, x, list(range(0, 3_000, 20)), 20)
    assert got.pop(7_100)[0][0] == 7_101 and set(got) == set(want)
    assert all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    for q, found in got.items():
        assert np.allclose([s for _, s in found], [x[q] @ x[i] for i, _ in found], rtol=1e-12, atol=1e-12)


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], VECTORS)
    for search in (top_k.top_inner_products, multi_index.nearest):
        assert [(r.query_id, r["rank"], r.vec_id) for r in search(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1), (0, 2, 2)]
        assert search(few.filter("vec_id = 0"), F.lit(True)).count() == 0
        assert search(few.filter("false"), F.lit(True)).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (400, 8), dtype=np.uint8)
    for radius in (0, 5, 19, 26):
        near = multi_index.distances(codes[:50], codes) <= radius
        assert (multi_index.within(codes[:50], codes, radius) | ~near).all()


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="needs the small tables")
def test_pipeline_decisions_take_effect(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.cut(stage(spark, docs, FOLDER))
        assert docs.columns == before.columns
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if name == "secrets":
            assert docs.count() == before.count()
            assert secret_scan.scan(docs).agg(F.sum(F.col("n_access") + F.col("n_hex"))).first()[0] == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert out.select("doc_id").distinct().count() == docs.count()
    assert docs.count() > 100


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="needs the small tables")
def test_stages_take_awkward_and_empty_tables(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (90_000, "", None, None, None), (90_001, "aé " * 40_000, None, None, None)], docs.schema)
    for some in (docs.unionByName(odd), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, some.withColumn("score", F.lit(1)), FOLDER).count() >= 0


@pytest.mark.parametrize("dense", [True, False])
def test_top_k_gathers_no_rows_where_bounds_do_not_prune(monkeypatch, dense):
    """Vectors of like lengths in all directions: nearly every pair stays open, and blocks are multiplied whole."""
    rng = np.random.default_rng(4)
    x = np.floor(64 * rng.normal(size=(3_000, 32)))
    ids, asked = np.arange(3_000), np.arange(0, 3_000, 10)
    gathered, plain = [], top_k.dots
    monkeypatch.setattr(top_k, "dots", lambda a, b, largest: gathered.append(len(a)) or plain(a, b, largest))
    if not dense:
        monkeypatch.setattr(top_k, "DENSE", 1.0)
    seeds = ids[:40], x[:40]
    query, found, value = top_k.best_pairs(np.eye(32), seeds, 20)(asked, x[asked], ids, x)
    got = {}
    for q, c, v in zip(asked[query], found, value):
        got.setdefault(int(q), []).append((int(c), float(v)))
    assert got == best(ids, x, asked, 20)
    assert sum(gathered) < 0.05 * len(asked) * len(ids) or not dense
