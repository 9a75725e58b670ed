"""Many KMeans fits in shared passes, against plain numpy."""

import numpy as np

from inkgraph.operators import multi_kmeans


def test_fits_against_numpy(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 3)) * 6
    x = np.vstack([c + rng.normal(size=(40, 3)) for c in centres])
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)]
    rows += [(900, None), (901, [1.0, float("nan"), 2.0]), (902, [1.0, 2.0]), (903, [None, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    fitted = multi_kmeans.fit_many(df, "id", "v", [2, 3, 4], restarts=4, seed=1)
    assert fitted.ks == [2] * 4 + [3] * 4 + [4] * 4
    for f, c in enumerate(fitted.centres):
        d2 = ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
        near = d2.argmin(1)
        assert abs(d2.min(1).sum() - fitted.inertia[f]) < 1e-6 * max(1.0, fitted.inertia[f])
        means = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        after = ((x[:, None, :] - means[None, :, :]) ** 2).sum(2).min(1).sum()
        assert after >= fitted.inertia[f] * (1 - 1e-3)     # converged: one more Lloyd step gains almost nothing
    assert fitted.rounds < 300
    best, inertia = fitted.best(4)
    assert inertia == min(fitted.inertia[8:])
    assigned = {r.id: r.cluster for r in multi_kmeans.assign(df, "v", best).collect()}
    assert all(assigned[i] is None for i in (900, 901, 902, 903))
    expect = ((x[:, None, :] - best[None]) ** 2).sum(2).argmin(1)
    assert [assigned[i] for i in range(len(x))] == expect.tolist()


def test_empty_and_small(spark):
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert multi_kmeans.fit_many(empty, "id", "v", [2], 3).ks == []
    two = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    assert multi_kmeans.fit_many(two, "id", "v", [2, 3], 2).ks == [2, 2]
