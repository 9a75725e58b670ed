"""Walks against a walk made step by step, and what a step reads."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from inkgraph.operators import walks


def uniform(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def one_walk(edges, walk, node, max_steps):
    """(nodes by first visit, moves); an edge that leads nowhere ends the walk."""
    path, moves = [node], 0
    for step in range(1, max_steps + 1):
        out = [(hashlib.md5(d.encode()).hexdigest() if d is not None else "", d or "", d, w) for s, d, w in edges if s == path[-1] and w and w > 0]
        if not out or uniform(walk, step, "stop", 42) < 0.15:
            break
        u, upto, total = uniform(walk, step, "move", 42), 0.0, math.fsum(w for *_, w in out)
        for _, _, dst, w in sorted(out, key=lambda e: e[:2]):
            upto += w
            if u < upto / total:
                break
        if dst is None:
            break
        path.append(dst)
        moves += 1
    return list(dict.fromkeys(path)), moves


def test_walks_are_those_made_one_by_one(spark, monkeypatch):
    rng = random.Random(4)
    edges = [("hub", f"n{i:03d}", float(rng.choice([1, 2, 5, 4_000]))) for i in range(90)]
    edges += [(f"n{i:03d}", rng.choice(["hub", "n001", "n050", "end"]), float(rng.randrange(3))) for i in range(90) for _ in range(3)]
    edges += [("hub", None, 700.0), ("n001", None, 1.0), (None, "hub", 3.0), ("hub", "n001", 2.0)]
    table = spark.createDataFrame(edges, "src string, dst string, weight double")
    at = ["hub", "n001", "n007", "end", "unknown"]
    starts = spark.range(300).select(F.col("id").alias("walk_id"), F.get(F.array(*map(F.lit, at)), F.col("id") % 5).alias("start"))
    want = {i: one_walk(edges, i, at[i % 5], 6) for i in range(300)}
    assert sum(moves > 3 for _, moves in want.values()) > 30

    def found():
        return {r.walk_id: (r.path, r.n_moves) for r in walks.random_walks(table, starts, max_steps=6).collect()}
    assert found() == want
    for name, value in {"CHUNK_EDGES": 20, "BUCKETS": 3, "WIDE": 8, "SLOT_EDGES": 4, "RUN": 3}.items():
        monkeypatch.setattr(walks, name, value)
    assert found() == want


def test_a_step_reads_few_rows_of_a_node(spark):
    """Forty edges of a node are a row for each of its slots (before: more than a hundred rows)."""
    edges = spark.createDataFrame([("a", f"n{i:03d}", 1.0 + i % 3) for i in range(40)], "src string, dst string, weight double")
    few, many = walks._interval_parts(edges)
    rows = walks._slots(few).collect()
    assert len(rows) == walks.MIN_SLOTS and many.count() == 0
    assert {end for r in rows for end in r.ends} == {f"n{i:03d}" for i in range(40)}
    assert sum(len(r.ends) for r in rows) <= 40 + walks.MIN_SLOTS
