"""TF-IDF, matching, split, metrics, classifier, embeddings and clusterings on small inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkgraph.operators import (
    classifier, clustering, evaluation, hierarchy, lsa, profiles, silhouette, similarity, split, tfidf,
)
from inkgraph.plans import reports as plans
from inkgraph.sources import tables

TEXTS = [
    (0, "red apple red pear", "fruit"), (1, "green pear", "fruit"), (2, "", "fruit"), (3, "blue car fast car", "car"),
    (4, "fast red car", "car"), (5, "one", "car"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "id long, text string, kind string")


def test_weights_follow_the_formula(docs):
    model = tfidf.fit(docs, "text", 100)
    got = {(r["id"], r["term"]): r["weight"] for r in model.weights(docs, "id", "text").collect()}
    n, df = 6, {"red": 2, "apple": 1, "pear": 2, "red apple": 1, "apple red": 1, "red pear": 1}
    raw = {t: (1 + math.log(2 if t == "red" else 1)) * (math.log((1 + n) / (1 + d)) + 1) for t, d in df.items()}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    assert {t: w for (i, t), w in got.items() if i == 0} == pytest.approx({t: x / norm for t, x in raw.items()})
    assert not any(i == 2 for i, _ in got) and got[(5, "one")] == 1.0


def test_vocabulary_is_the_most_frequent(docs):
    assert [r["term"] for r in tfidf.vocabulary(docs, "text", 3).collect()] == ["car", "red", "fast"]


def test_transform_drops_unknown_terms(spark, docs):
    model = tfidf.fit(docs, "text", 3)
    other = spark.createDataFrame([(9, "car unknown things"), (10, "nothing")], "id long, text string")
    rows = {r["id"]: r for r in model.transform(other, "text").collect()}
    assert rows[9]["weights"] == [1.0] and rows[10]["weights"] == []
    with pytest.raises(ValueError):
        tfidf.fit(other.filter("id > 10"), "text", 3)


def test_matches_do_not_depend_on_blocks(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    made = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 12)))) for i in range(60)]
    rows = spark.createDataFrame(made, "id long, text string")
    model = tfidf.fit(rows, "text", 200)
    left = model.transform(rows.filter("id < 40"), "text")
    right = model.transform(rows.filter("id >= 40").withColumnRenamed("id", "ref"), "text")
    whole = similarity.top_matches(left, "id", right, "ref", 3)
    parts = similarity.top_matches(left, "id", right, "ref", 3, block_entries=40, block_docs=15)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    dense = {}
    for frame, key in ((left, "id"), (right, "ref")):
        for r in frame.collect():
            v = np.zeros(model.size)
            v[r["indices"]] = r["weights"]
            dense[r[key]] = v
    for i in range(40):
        sims = sorted((-round(float(dense[i] @ dense[j]), 6), j) for j in range(40, 60))[:3]
        mine = [(-r["similarity"], r["ref"]) for r in whole.filter(F.col("id") == i).orderBy("rank").collect()]
        assert mine == [s for s in sims if s[0] < 0]


def test_split_is_exact_and_repeatable(spark):
    rows = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("label"))
    one = split.stratified_split(rows, "id", "label")
    two = split.stratified_split(rows.repartition(7), "id", "label")
    counts = {r["label"]: (r["n"], r["t"]) for r in one.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert counts == {"rare": (101, 20), "common": (902, 181)}      # ceil(0.2 * 1003) = 201
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}
    held = [r["id"] for r in one.filter("is_test AND label = 'rare'").collect()]
    import hashlib
    rare = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in range(0, 1003, 10))
    assert sorted(held) == sorted(i for _, i in rare[:20])


def test_class_report(spark):
    rows = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("b", "c"), ("a", "a")], "y string, p string")
    counts = evaluation.confusion(rows, "y", {"m": "p"})
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in evaluation.full_report(counts).collect()}
    third = 2 / 3
    assert got["a"] == pytest.approx((1, third, .8, 3)) and got["b"] == pytest.approx((third, third, third, 3))
    assert got["c"] == (0, 0, 0, 0)
    assert got["macro avg"] == pytest.approx(((1 + third) / 3, 2 * third / 3, (.8 + third) / 3, 6))
    assert got["weighted avg"] == pytest.approx(((1 + third) / 2, third, (.8 + third) / 2, 6))
    assert got["accuracy"][0] == pytest.approx(third)


def labelled(spark):
    rnd = random.Random(1)
    words = {"x": ["alpha", "beta", "gamma"], "y": ["delta", "eps", "zeta"], "z": ["eta", "theta", "iota"]}
    rows = [(i, " ".join(rnd.choices(words["xyz"[i % 3]], k=6) + rnd.choices(["and", "the"], k=3)), "xyz"[i % 3])
            for i in range(60)]
    return spark.createDataFrame(rows, "id long, text string, label string")


def test_classifier_learns(spark):
    rows = labelled(spark)
    assert classifier.enough_rows(rows) and not classifier.enough_rows(rows.limit(10))
    model = classifier.fit(rows, "text", "label", max_features=100)
    assert model.labels == ["x", "y", "z"]
    assert model.predict(rows, "text").filter("predicted <> label").count() == 0
    row = model.rank(spark.createDataFrame([("theta iota",)], "text string"), "text", 3).first()
    assert row["ranked"][0]["label"] == "z" and sum(e["score"] for e in row["ranked"]) == pytest.approx(1, abs=2e-4)
    assert {r[0] for r in classifier.label_index(rows, "label").filter("label = 'y'").select("label_idx").collect()} == {1.0}
    done = plans.classify_reports(tables.sample_reports(spark), "id", "title", "text", model)
    assert all(len(r["supervised"]) == 3 and len(r["zero_shot"]) == 3 and r["text_preview"].endswith("...") for r in done.collect())
    assert plans.train_if_enough(rows.limit(5), "text", "label") is None


def test_evaluate_two_classifiers(spark):
    result = plans.evaluate_classifiers(labelled(spark), "id", "text", "label", max_features=100)
    rows = {(r["model"], r["label"]): r for r in result.report.collect()}
    assert rows["supervised", "accuracy"]["precision"] == 1.0 and rows["supervised", "accuracy"]["support"] == 12
    assert rows["zero_shot", "accuracy"]["precision"] == 0.0


def test_lsa_matches_numpy(spark):
    rows = labelled(spark)
    model = lsa.fit(rows, "text", 4, 100)
    dense = np.zeros((60, model.features.size))
    for r in model.features.transform(rows, "text").collect():
        dense[r["id"], r["indices"]] = r["weights"]
    values = np.linalg.svd(dense, compute_uv=False)
    assert model.singular_values == pytest.approx(values[:4], rel=1e-6)
    embedded = {r["id"]: np.array(r["embedding"]) for r in model.transform(rows, "text").collect()}
    assert all(np.linalg.norm(v) == pytest.approx(1) for v in embedded.values())
    expected = dense @ model.components
    assert np.allclose(embedded[7], expected[7] / np.linalg.norm(expected[7]))


def points(spark, n=60, groups=3, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=3) * 0.3 + 4 * np.eye(3)[i % groups]).tolist(), i % groups) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int"), rows


def test_projection_is_centred(spark):
    df, _ = points(spark)
    row = lsa.project_2d(df, "v").agg(F.avg("x"), F.avg("y"), F.var_pop("x") >= F.var_pop("y")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(0, abs=1e-9) and row[2]


def brute_silhouette(rows):
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    d = np.linalg.norm(x[:, None] - x[None, :], axis=2)
    out = []
    for i in range(len(rows)):
        mine = (label == label[i]) & (np.arange(len(rows)) != i)
        if not mine.any():
            out.append(0.0)
            continue
        a = d[i][mine].mean()
        b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
        out.append((b - a) / max(a, b))
    return out


def test_silhouette_equals_brute_force(spark):
    df, rows = points(spark)
    rows = rows + [(99, [9.0, 9.0, 9.0], 7)]
    df = spark.createDataFrame(rows, df.schema)
    for block in (2000, 7):
        got = {r["id"]: r["silhouette"] for r in silhouette.values(df, "id", "v", "label", block).collect()}
        assert [got[r[0]] for r in rows] == pytest.approx(brute_silhouette(rows), abs=1e-7)
    assert silhouette.score(df.filter("label = 0"), "id", "v", "label") == 0.0
    assert silhouette.score(df, "id", "v", "label", "squared") > 0.8


def test_kmeans_inertia_and_nearest(spark):
    df, _ = points(spark)
    result = clustering.kmeans(df, "v", 3, restarts=3)
    assert result.assigned.groupBy("label").agg(F.count_distinct("cluster").alias("n")).filter("n > 1").count() == 0
    assert clustering.inertia(result.assigned, "v").first()[0] == pytest.approx(result.inertia)
    near = clustering.nearest_centroid(df, "v", clustering.centroids(df, "v", "label"), "label")
    assert near.filter("nearest <> label").count() == 0
    sweep = clustering.sweep_k(df.limit(4), "id", "v", restarts=1).collect()
    assert [r["k"] for r in sweep] == [2, 3] and sweep[0]["inertia"] >= sweep[1]["inertia"]
    assert clustering.bisecting(df, "v", 3).select("cluster").distinct().count() == 3


def test_blocks_stay_few_and_several_clusterings_share_the_distances(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist(), i % 2, i % 3, 0) for i in range(40)],
                               "id long, v array<float>, p int, q int, one int")
    assert silhouette.block_count(df, 615_000, 2_000) == silhouette.block_count(df, 100_000, 2_000)     # 2,000 a block: 308 and 50
    got = silhouette.euclidean_scores(df, "id", "v", ["p", "q", "one"], 6)
    assert got == pytest.approx([silhouette.score(df, "id", "v", c) for c in ("p", "q", "one")], abs=1e-9)


def test_term_frequency_exchanges_texts_only(spark):
    df = spark.createDataFrame([(1, "red red car"), (1, "red"), (None, "car car"), (None, "car"), (2, None)], "id long, text string")
    counted = tfidf.term_frequency(df, "id", "text")
    assert {(r["id"], r["term"]): r["tf"] for r in counted.collect()} == {
        (1, "red"): 3, (1, "red red"): 1, (1, "car"): 1, (1, "red car"): 1, (None, "car"): 3, (None, "car car"): 1}
    plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(id") == 1 and "Exchange hashpartitioning(id, term" not in plan.replace("#", " ")


def brute_ward(rows, k):
    clusters = [([r[0]], np.array(r[1])) for r in rows]
    while len(clusters) > k:
        best = min(
            ((len(a[0]) * len(b[0]) / (len(a[0]) + len(b[0])) * ((a[1] - b[1]) ** 2).sum(), i, j)
             for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j))
        _, i, j = best
        a, b = clusters[i], clusters[j]
        joint = (a[0] + b[0], (a[1] * len(a[0]) + b[1] * len(b[0])) / (len(a[0]) + len(b[0])))
        clusters = [c for n, c in enumerate(clusters) if n not in (i, j)] + [joint]
    return {frozenset(c[0]) for c in clusters}


@pytest.mark.parametrize("block", [2000, 6])
def test_ward_equals_one_by_one_merging(spark, block):
    rng = np.random.default_rng(11)
    rows = [(i * 3, rng.normal(size=2).tolist()) for i in range(24)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {}
    for r in hierarchy.ward(df, "id", "v", 5, block).collect():
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert {frozenset(x) for x in got.values()} == brute_ward(rows, 5)
    assert set(got) == set(range(5))


@pytest.mark.parametrize("last, block", [(9, 7), (2_000, 2_000)])
def test_ward_keeps_what_it_found_between_rounds(spark, last, block):
    rng = np.random.default_rng(5)
    rows = [(i * 3, np.round(rng.normal(size=3), 1).tolist()) for i in range(40)]      # rounded: some costs are equal
    rows += [(1_000 + i, rows[i][1]) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {}
    for r in hierarchy.ward(df, "id", "v", 5, block, last).collect():
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert {frozenset(x) for x in got.values()} == brute_ward(rows, 5)


def test_ward_searches_little_again_and_joins_equal_rows_at_once(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i * 5 - 600, rng.normal(size=8).tolist()) for i in range(240)]
    rows += [(10_000 + i, rows[0][1]) for i in range(30)]
    looks, search = [], hierarchy._search
    monkeypatch.setattr(hierarchy, "_search", lambda clusters, n, stale, *a: looks.append((n, stale)) or search(clusters, n, stale, *a))
    df = spark.createDataFrame(rows, "id long, v array<double>")
    merges = [tuple(r) for r in hierarchy.ward_merges(df, "id", "v", 50, 120).collect()]
    assert len(merges) == 269 and len({gone for _, gone, _ in merges}) == 269
    assert sum(cost == 0 for _, _, cost in merges) == 30 and {kept for kept, _, cost in merges if cost == 0} == {-600}
    assert looks[0] == (240, 240) and len(looks) < 12
    assert all(stale < 0.8 * n for n, stale in looks[1:]) and sum(n * stale for n, stale in looks) < 2 * 240 ** 2


@pytest.mark.parametrize("shift, places", [(0.0, 9), (1e3, 9), (0.0, 1), (0.0, 0)])
def test_ward_lists_are_whole(shift, places):
    rng = np.random.default_rng(3)
    y = np.round(rng.normal(size=(1_500, 6)), places) + shift
    m, ys = rng.integers(1, 9, 1_500).astype(float), rng.permutation(3_000)[:1_500] - 900
    at = rng.permutation(1_500)[:300]
    new, cost_y, other_y = np.arange(300) % 3 > 0, np.full(1_500, 0.9), np.full(1_500, 5)
    cost_y[at] = np.nan
    exact = np.stack([hierarchy._costs(y[i], m[i], y, m) for i in at])
    exact[np.arange(300), at] = np.inf
    costs, others, (to, cost, other) = hierarchy._nearest(y[at], m[at], ys[at], y, m, ys, 13, new, cost_y, other_y)
    order = np.array([np.lexsort((ys, row))[:13] for row in exact])
    assert np.array_equal(costs, np.take_along_axis(exact, order, 1)) and np.array_equal(others, ys[order])
    below = new[:, None] & ((exact < cost_y) | ((exact == cost_y) & (ys[at][:, None] < other_y)))
    wanted = {(c, exact[r, c], ys[at[r]]) for r, c in zip(*np.nonzero(below))}
    assert len(to) == len(wanted) > 0 and set(zip(to, cost, other)) == wanted


def test_ward_takes_repeated_keys_and_refuses_nan(spark):
    rows = [(i, [10.0 * (i % 2) + i / 10]) for i in range(6)]
    got = hierarchy.ward(spark.createDataFrame(rows + rows, "id long, v array<double>"), "id", "v", 2).collect()
    assert {(r["id"], r["cluster"]) for r in got} == {(i, i % 2) for i in range(6)}
    with pytest.raises(ValueError):
        hierarchy.ward(spark.createDataFrame([(1, [0.0]), (2, [float("nan")]), (3, [5.0])], "id long, v array<double>"), "id", "v", 2)


def test_profiles_fall_back(spark):
    docs = spark.createDataFrame([(1, "t1"), (2, "t2")], "id long, title string")
    km = spark.createDataFrame([(1, 0), (2, 9)], "id long, cluster int")
    words = spark.createDataFrame([(0, ["a", "b"])], "cluster int, top_keywords array<string>")
    rows = {r["report_id"]: r for r in profiles.profiles(
        docs, "id", "title", km, km, tables.profile_names(spark), words).collect()}
    assert rows[1]["actor_profile"] == "Advanced Persistent Threat (APT)" and rows[1]["top_keywords"] == ["a", "b"]
    assert rows[2]["actor_profile"] == "Cluster-9" and rows[2]["top_keywords"] == [] and rows[2]["hac_cluster"] == 9


def test_cluster_the_sample_reports(spark):
    out = plans.cluster_reports(
        tables.sample_reports(spark).withColumn("n", F.xxhash64("id")), "n", "title", "text", tables.profile_names(spark),
        k=4, n_components=4, restarts=2)
    assert out.profiles.count() == out.scatter.count() == 5
    assert out.profiles.select("kmeans_cluster").distinct().count() == 4
    assert out.profiles.select("hac_cluster").distinct().count() == 4
    assert -1 <= out.km_silhouette <= 1 and -1 <= out.hac_silhouette <= 1
    assert out.keywords.groupBy("cluster").count().filter("count <> 8").count() == 0
