"""Golden values on the given graph, and edge cases of the graph operators."""

import pytest
from pyspark.sql import functions as F

from inkgraph import session
from inkgraph.operators import betweenness, graph, pagerank, paths, skew, walks
from inkgraph.sources import tables

PAGERANK = {
    "Lateral Movement": .1072, "Discovery": .1071, "Credential Access": .1071, "Defense Evasion": .1070,
    "Impact": .0891, "Execution": .0878, "Command and Control": .0763, "Collection": .0708, "Persistence": .0547,
    "Exfiltration": .0532, "Privilege Escalation": .0523, "Initial Access": .0415, "Resource Development": .0298,
    "Reconnaissance": .0161,
}
BETWEENNESS = {
    "Lateral Movement": .3333, "Discovery": .3269, "Credential Access": .3205, "Defense Evasion": .3141, "Impact": 0,
    "Execution": .2949, "Command and Control": .1410, "Collection": .1923, "Persistence": .2436, "Exfiltration": 0,
    "Privilege Escalation": 0, "Initial Access": .1410, "Resource Development": .0769, "Reconnaissance": 0,
}


@pytest.fixture(scope="module")
def chain(spark):
    return graph.build_graph(tables.graph_nodes(spark), tables.graph_edges(spark))


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_size_and_density(chain):
    assert tuple(graph.size_and_density(chain).first()) == (14, 16, 0.0879)


def test_degrees(chain):
    found = {r["id"]: (r["in_degree"], r["out_degree"]) for r in graph.degrees(chain).collect()}
    assert found["Execution"] == (2, 2) and found["Impact"] == (2, 0) and found["Reconnaissance"] == (0, 1)


def test_pagerank_golden(chain):
    ranks = as_dict(pagerank.pagerank(chain))
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-9)
    assert ranks == pytest.approx(PAGERANK, abs=2e-4)


def test_pagerank_same_with_salted_hubs(chain, monkeypatch):
    plain = as_dict(pagerank.pagerank(chain, max_rounds=5))
    monkeypatch.setattr(pagerank, "BROADCAST_ROWS", 0)
    assert as_dict(pagerank.pagerank(chain, max_rounds=5)) == pytest.approx(plain, abs=1e-12)
    monkeypatch.setattr(pagerank, "find_hot", lambda df, key: skew.find_hot(df, key, rows=1, salts=3))
    assert as_dict(pagerank.pagerank(chain, max_rounds=5)) == pytest.approx(plain, abs=1e-12)


def test_betweenness_golden(chain):
    assert as_dict(betweenness.betweenness(chain)) == pytest.approx(BETWEENNESS, abs=6e-5)


def test_betweenness_without_edges(spark):
    none = spark.createDataFrame([], "src string, dst string, weight double")
    g = graph.build_graph(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"), none)
    assert as_dict(betweenness.betweenness(g)) == {"a": 0, "b": 0, "c": 0}


def test_betweenness_rejects_zero_cost(chain):
    with pytest.raises(ValueError):
        betweenness.betweenness(chain, cost="weight - weight")


def test_betweenness_counts_equal_paths(spark):
    edges = spark.createDataFrame(
        [("a", "b", 1.0), ("a", "c", 1.0), ("b", "d", 1.0), ("c", "d", 1.0), ("d", "e", 1.0)],
        "src string, dst string, weight double")
    g = graph.build_graph(spark.createDataFrame([("z",)], "id string"), edges)
    found = as_dict(betweenness.betweenness(g))
    # 6 nodes, scale 1/20: b and c lie on half of a->d and a->e; d lies on a->e, b->e, c->e
    assert found == pytest.approx({"a": 0, "b": .05, "c": .05, "d": .15, "e": 0, "z": 0})


def test_betweenness_batches_add_up(spark, chain):
    edges = spark.createDataFrame(
        [(f"n{i}", f"n{(i * 7 + j) % 23}", float(1 + (i + j) % 3)) for i in range(23) for j in (1, 2, 5)],
        "src string, dst string, weight double")
    g = graph.build_graph(spark.createDataFrame([("n0",)], "id string"), edges)
    whole = as_dict(betweenness.betweenness(g))
    assert as_dict(betweenness.betweenness(g, batch_sources=4)) == pytest.approx(whole, abs=1e-12)
    assert as_dict(betweenness.betweenness(chain, batch_sources=1)) == pytest.approx(BETWEENNESS, abs=6e-5)


def test_expand_to_members(spark):
    members = tables.class_members(spark).select(
        "class", F.concat_ws("::", "member_id", "member_name").alias("node"))
    kinds = as_dict(graph.expand_to_members(tables.graph_edges(spark), members).groupBy("edge_type").count())
    assert members.count() == 36 and kinds == {"intra_tactic": 72, "cross_tactic": 126}


def test_last_edge_wins(spark):
    rows = [("a", "b", 0.1, 1), ("a", "b", 0.7, 2), ("b", "a", 0.3, 1)]
    edges = graph.last_edge(spark.createDataFrame(rows, "src string, dst string, weight double, ord int"), "ord")
    assert {(r["src"], r["dst"]): r["weight"] for r in edges.collect()} == {("a", "b"): 0.7, ("b", "a"): 0.3}


PAIRS = [("Reconnaissance", "Exfiltration"), ("Reconnaissance", "Impact"), ("Initial Access", "Impact"),
         ("Execution", "Exfiltration"), ("nowhere", "Impact"), ("Impact", "Impact")]


def test_ranked_paths_golden(spark, chain):
    pairs = spark.createDataFrame(PAIRS, "start string, end string")
    found = paths.ranked_paths(chain.edges, pairs, top=5).orderBy("start", "rank").collect()
    listed = {}
    for row in found:
        assert len(set(row["path"])) == row["n_nodes"] == row["n_edges"] + 1
        listed.setdefault((row["start"], row["end"]), []).append((row["probability"], row["n_nodes"]))
    assert listed == {
        ("Initial Access", "Impact"): [(.105341, 10), (.098318, 10), (.070227, 11), (.065545, 11)],
        ("Execution", "Exfiltration"): [(.156060, 9), (.145656, 9)],
    }
    assert "Privilege Escalation" in found[0]["path"]


@pytest.mark.parametrize("cutoff, heavy", [(4, 1.0), (10, 1.0), (10, 1.5)])
def test_ranked_paths_equal_brute_force(spark, cutoff, heavy):
    """Also with weights over 1, where a longer walk may beat a shorter one."""
    import itertools, random
    rnd = random.Random(7)
    names = "abcdefg"
    weight = {(u, v): rnd.choice([0.2, 0.5, 0.9, heavy]) for u in names for v in names if u != v and rnd.random() < .6}
    edges = spark.createDataFrame([(*k, w) for k, w in weight.items()], "src string, dst string, weight double")
    pairs = [("a", "g"), ("b", "c")]
    found = paths.ranked_paths(edges, spark.createDataFrame(pairs, "start string, end string"), cutoff, top=3)
    for start, end in pairs:
        every = []
        others = [x for x in names if x not in (start, end)]
        for size in range(min(cutoff, len(others) + 1)):
            for middle in itertools.permutations(others, size):
                path = [start, *middle, end]
                if all(step in weight for step in zip(path, path[1:])):
                    p = 1.0
                    for step in zip(path, path[1:]):
                        p *= weight[step]
                    every.append((-round(p, 6), path))
        mine = found.filter((F.col("start") == start) & (F.col("end") == end)).orderBy("rank").collect()
        assert [(-r["probability"], r["path"]) for r in mine] == sorted(every)[:3]


def test_missing_weight_counts_half(spark):
    edges = spark.createDataFrame([("a", "b", None), ("b", "c", 0.4)], "src string, dst string, weight double")
    row = paths.ranked_paths(edges, spark.createDataFrame([("a", "c")], "start string, end string")).first()
    assert row["probability"] == 0.2


def test_scenarios(spark, chain):
    rows = {r["name"]: r for r in paths.run_scenarios(chain.edges, tables.scenarios(spark)).collect()}
    assert rows["APT Espionage Campaign"]["best_path"] == [] and rows["APT Espionage Campaign"]["hops"] == 0
    assert rows["Ransomware Attack"]["best_probability"] == .105341 and rows["Ransomware Attack"]["n_paths"] == 3
    assert rows["Insider Threat"]["hops"] == 9
    for row in rows.values():
        assert row["random_walk"][0] == row["start"] and len(set(row["random_walk"])) == len(row["random_walk"])


def test_scenario_without_edges_walks_nowhere(spark):
    edges = spark.createDataFrame([], "src string, dst string, weight double")
    one = spark.createDataFrame([("n", "a", "b", "d")], "name string, start string, end string, description string")
    row = paths.run_scenarios(edges, one).first()
    assert row["best_path"] == [] and row["n_paths"] == 0 and row["random_walk"] == ["a"]


@pytest.mark.parametrize("start, expected", [
    ("Reconnaissance", {"Resource Development": .85, "Initial Access": .7225, "Execution": .706772,
                        "Lateral Movement": .272491, "Impact": .091800}),
    ("Initial Access", {"Execution": .978231, "Defense Evasion": .706772, "Lateral Movement": .434046,
                        "Impact": .127058}),
    ("Execution", {"Execution": 1.173618, "Discovery": .600756, "Lateral Movement": .510643, "Impact": .149481}),
])
def test_expected_visits_golden(spark, chain, start, expected):
    visits = graph.expected_visits(chain.edges, spark.createDataFrame([(start,)], "start string"))
    found = {r["node"]: r["visits"] for r in visits.collect()}
    assert {node: found[node] for node in expected} == pytest.approx(expected, abs=1e-6)


def test_walks_follow_edges_and_repeat(spark, chain):
    starts = spark.range(400).select(F.col("id").alias("walk_id"), F.lit("Initial Access").alias("start"))
    one = {r["walk_id"]: r["path"] for r in walks.random_walks(chain.edges, starts).collect()}
    two = {r["walk_id"]: r["path"] for r in walks.random_walks(chain.edges.repartition(3), starts.repartition(7)).collect()}
    assert one == two and len(one) == 400
    steps = {(r["src"], r["dst"]) for r in chain.edges.collect()}
    for path in one.values():
        assert path[0] == "Initial Access" and len(path) == len(set(path))
        assert len(path) < 2 or tuple(path[:2]) in steps
    reached = sum("Execution" in p for p in one.values()) / 400
    assert reached == pytest.approx(.85, abs=.06)


def test_walk_intervals_cover_and_chunks_agree(spark, monkeypatch):
    rows = [("a", f"n{i:03d}", float(i % 5 + 1)) for i in range(40)] + [("b", "a", 2.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    def check():
        got = walks.intervals(edges).orderBy("src", "lo").collect()
        for node in "ab":
            mine = [r for r in got if r["src"] == node]
            assert mine[0]["lo"] == 0.0 and mine[-1]["hi"] == 1.0
            assert all(x["hi"] == y["lo"] for x, y in zip(mine, mine[1:]))
        return {(r["src"], r["dst"]): r["hi"] - r["lo"] for r in got}
    whole = check()
    monkeypatch.setattr(walks, "CHUNK_EDGES", 7)
    assert check() == pytest.approx(whole)


def test_walks_are_the_same_for_any_chunk_size(spark, monkeypatch):
    rows = [("a", f"n{i:03d}", float(i % 5 + 1)) for i in range(40)] + [(f"n{i:03d}", "a", 1.0) for i in range(40)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    starts = spark.range(100).select(F.col("id").alias("walk_id"), F.lit("a").alias("start"))
    def found():
        return sorted(tuple(map(str, r)) for r in walks.random_walks(edges, starts, max_steps=4).collect())
    whole = found()
    monkeypatch.setattr(walks, "CHUNK_EDGES", 7)
    assert found() == whole


def test_nodes_without_weight_are_sinks(spark):
    rows = [("a", "b", 0.0), ("a", "c", 0.0), ("b", "a", 1.0), ("b", "c", 0.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    moves = {(r["src"], r["dst"]): r["p"] for r in graph.transition_probabilities(edges).collect()}
    assert moves == {("b", "a"): 1.0, ("b", "c"): 0.0}
    starts = spark.createDataFrame([(1, "a"), (2, "b")], "walk_id int, start string")
    paths_found = {r["walk_id"]: r["path"] for r in walks.random_walks(edges, starts, stop_probability=0.0).collect()}
    assert paths_found == {1: ["a"], 2: ["b", "a"]}
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    ranks = as_dict(pagerank.pagerank(graph.build_graph(nodes, edges)))
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-6)


def test_transitions_across_chunks(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 11, "a"), (1, 35, "c"), (2, 3, "b"), (2, 40, "b")]
    events = spark.createDataFrame(rows, "who int, at int, what string")
    for width in (1000, 10, 1):
        found = graph.transitions(events, "who", ["at"], "what", F.floor(F.col("at") / width))
        assert {(r[0], r[1]): r[2] for r in found.collect()} == {
            ("a", "b"): 1.0, ("b", "a"): 1.0, ("a", "c"): 1.0, ("b", "b"): 1.0}


def test_hot_join_equals_plain_join(spark):
    many = spark.range(1000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), "id")
    few = spark.createDataFrame([(0, "x"), (1, "y"), (5, "z")], "k long, name string")
    hot = skew.find_hot(many, "k", rows=100, salts=5)
    assert 0 in hot.values
    for how in ("inner", "left"):
        spread = skew.spread_join(many, few, "k", ["id"], how, hot)
        assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, many.join(few, "k", how).collect()), key=str)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookup_join_plans_without_jobs(spark, threshold):
    """The same rows with and without room for a broadcast; nothing runs before an action."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        many = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
        few = many.groupBy("k").agg(F.count("*").alias("n"))
        spark.sparkContext.setJobGroup(f"planning {threshold}", "no job expected")
        joined = skew.lookup_join(many, few, "k", "left")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"planning {threshold}")
        assert joined.filter("n is not null").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pagerank_places_edges_in_one_exchange(spark, chain, monkeypatch):
    """With many nodes the edges go once to where the rounds need them; before, they were exchanged and written three times."""
    monkeypatch.setattr(pagerank, "BROADCAST_ROWS", 0)
    written = []
    monkeypatch.setattr(pagerank, "cut", lambda df: written.append(set(df.columns)) or session.cut(df))
    ranks = as_dict(pagerank.pagerank(chain, max_rounds=5))
    assert sum(ranks.values()) == pytest.approx(1.0)
    assert not any({"src", "dst"} <= columns for columns in written)
