"""Nearest neighbours on tables whose ids follow clusters."""

import numpy as np

from inkgraph.llm import multi_index


def by_cluster(rng):
    """Tight groups first, then the same number of scattered directions."""
    tight = np.repeat(rng.normal(size=(75, 32)), 40, axis=0) + rng.normal(0, 0.01, (3_000, 32))
    x = np.concatenate((tight, rng.normal(size=(3_000, 32))))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_nearest_recall_where_ids_follow_clusters():
    x, top = by_cluster(np.random.default_rng(3)), 20
    ids, asked = np.arange(len(x)), np.arange(0, len(x), 20)
    directions = multi_index.learn_rotations(x, multi_index.BITS)
    query, found, _ = multi_index.best_pairs(directions, multi_index.learn_radius(x, directions, top), top)(asked, x[asked], ids, x)
    product = x[asked] @ x.T
    product[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-product, axis=1)[:, :top]
    recall = np.array([len(set(found[query == i]) & set(w)) / top for i, w in enumerate(want)])
    assert recall[: len(asked) // 2].mean() > 0.9 and recall[len(asked) // 2:].mean() > 0.9


def test_radius_follows_the_density_around_a_query():
    rng = np.random.default_rng(4)
    tight = np.repeat(rng.normal(size=(290, 32)), 40, axis=0) + rng.normal(0, 0.01, (11_600, 32))
    x = np.concatenate((tight, rng.normal(size=(400, 32))))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    directions = multi_index.learn_rotations(x, multi_index.BITS)
    radius = multi_index.learn_radius(x, directions, 20)
    assert radius.of(np.array([60]))[0] > 60 and (np.diff(radius.margins) >= 0).all()
