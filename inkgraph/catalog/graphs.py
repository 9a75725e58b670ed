"""Graphs made from the given tables, and every graph operator on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.catalog.common import load
from inkgraph.operators import betweenness, graph, pagerank, paths, walks
from inkgraph.operators.skew import lookup_join
from inkgraph.plans import graphs as plans
from inkgraph.session import cut
from inkgraph.sources import sinks, tables

CUTOFF = 10


# --- the graphs --------------------------------------------------------------

def sales(spark: SparkSession, folder: str) -> DataFrame:
    """(cust, supp, quantity): quantities per customer and supplier.  Lines of an order rarely share a supplier, so they are summed only here."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("quantity"))
    orders = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cust"))
    return lookup_join(lines, orders, "l_orderkey").groupBy("cust", "supp").agg(F.sum("quantity").alias("quantity"))


def trade(spark: SparkSession, folder: str) -> DataFrame:
    """Edges from the nation of the supplier to the nation of the customer, weighted by quantity."""
    def home(table: str, key: str, nation: str, name: str, out: str) -> DataFrame:
        nations = F.broadcast(load(spark, folder, "nation").select(F.col("n_nationkey").alias(nation), F.col("n_name").alias(out)))
        return load(spark, folder, table).join(nations, nation).select(F.col(key).alias(name), out)   # nations: 25 rows

    pairs = lookup_join(sales(spark, folder), home("supplier", "s_suppkey", "s_nationkey", "supp", "src"), "supp")
    pairs = pairs.groupBy("cust", "src").agg(F.sum("quantity").alias("quantity"))
    pairs = lookup_join(pairs, home("customer", "c_custkey", "c_nationkey", "cust", "dst"), "cust")
    return pairs.groupBy("src", "dst").agg(F.sum("quantity").alias("weight"))


def whole_trade(spark: SparkSession, folder: str) -> DataFrame:
    """All trade edges, with weights also as shares of the nation's trade."""
    edges = cut(trade(spark, folder))
    shares = graph.transition_probabilities(edges).withColumnRenamed("p", "share")
    return cut(edges.join(shares, ["src", "dst"]))


def nation_nodes(spark, folder):
    return load(spark, folder, "nation").select(
        F.col("n_name").alias("id"), F.concat(F.lit("Region "), "n_regionkey").alias("description"), F.lit("nation").alias("type")
    )


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """Customer -> supplier (quantity), supplier -> nation (1), nation -> customer (number of orders)."""
    bought = sales(spark, folder).select(
        F.concat(F.lit("C"), "cust").alias("src"), F.concat(F.lit("S"), "supp").alias("dst"), F.col("quantity").alias("weight")
    )
    seated = load(spark, folder, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("src"), F.concat(F.lit("N"), "s_nationkey").alias("dst"), F.lit(1.0).alias("weight")
    )
    orders = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").cast("double").alias("weight")
    )
    placed = load(spark, folder, "customer").join(orders, "c_custkey").select(
        F.concat(F.lit("N"), "c_nationkey").alias("src"), F.concat(F.lit("C"), "c_custkey").alias("dst"), "weight"
    )
    return bought.unionByName(seated).unionByName(placed)


def flow_graph(spark, folder) -> graph.Graph:
    """All customers are nodes, with or without orders; suppliers and nations come from the edges."""
    customers = load(spark, folder, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"))
    return graph.build_graph(customers, cut(flows(spark, folder)))


def event_steps(spark, folder) -> DataFrame:
    return graph.transitions(
        load(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type", F.date_trunc("hour", "ts")
    )


# --- queries -----------------------------------------------------------------

def g1_build_graph(spark, folder):
    """Only some nations are given as nodes; the others are added from the edges."""
    some = nation_nodes(spark, folder).filter("description = 'Region 1'")
    return graph.build_graph(some, trade(spark, folder)).nodes


def g2_last_edge(spark, folder):
    orders = load(spark, folder, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("src"), F.col("o_orderpriority").alias("dst"),
        F.col("o_totalprice").alias("weight"), F.struct("o_orderdate", "o_orderkey").alias("ord"),
    )
    return graph.last_edge(orders, "ord")


def g3_expand_to_members(spark, folder):
    nations = load(spark, folder, "nation")
    members = nations.select(F.col("n_regionkey").cast("string").alias("class"), F.col("n_name").alias("node"))
    region = nations.select(F.col("n_name").alias("id"), F.col("n_regionkey").cast("string").alias("r"))
    edges = (
        trade(spark, folder).join(region.toDF("src", "from"), "src").join(region.toDF("dst", "to"), "dst")
        .filter(F.col("from") < F.col("to"))
        .groupBy(F.col("from").alias("src"), F.col("to").alias("dst")).agg(F.sum("weight").alias("weight"))
    )
    return graph.expand_to_members(edges, members)


def g4_degrees(spark, folder):
    return graph.degrees(flow_graph(spark, folder))


def g5_density(spark, folder):
    return graph.size_and_density(flow_graph(spark, folder))


def g6_pagerank(spark, folder):
    ranks = pagerank.pagerank(flow_graph(spark, folder))
    return ranks.select("id", F.round("pagerank", 8).alias("pagerank"))


def g6_pagerank_converged(spark, folder):
    """All trade edges, ranks rounded as they are shown."""
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder))
    return pagerank.pagerank(g).select("id", F.round("pagerank", 4).alias("pagerank"))


def g7_top_nodes(spark, folder):
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder))
    ranks = pagerank.pagerank(g)
    return pagerank.top_nodes(ranks.select("id", F.round("pagerank", 8).alias("pagerank")), 5)


def g8_betweenness(spark, folder):
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder))
    found = betweenness.betweenness(g)
    return found.select("id", F.round("betweenness", 6).alias("betweenness"))


def _shared_edges(spark, folder):
    return whole_trade(spark, folder).select("src", "dst", F.col("share").alias("weight"))


def _all_pairs(spark, folder):
    """Every nation to every other one."""
    nations = load(spark, folder, "nation").agg(F.collect_set("n_name").alias("names"))      # 25 names
    return nations.select(F.explode("names").alias("start"), "names").select("start", F.explode("names").alias("end"))


def g9_g12_ranked_paths(spark, folder):
    found = paths.ranked_paths(_shared_edges(spark, folder), _all_pairs(spark, folder), CUTOFF, 5)
    return found.withColumn("path", F.array_join("path", ">"))


def g11_path_steps(spark, folder):
    found = paths.ranked_paths(_shared_edges(spark, folder), _all_pairs(spark, folder), CUTOFF, 2)
    return paths.path_steps(found, ["start", "end", "rank"])


def g13_transition_probabilities(spark, folder):
    moves = graph.transition_probabilities(flows(spark, folder))
    return moves.select("src", "dst", F.round("p", 8).alias("p"))


def g13_event_transitions(spark, folder):
    moves = graph.transition_probabilities(event_steps(spark, folder))
    return moves.select("src", "dst", F.round("p", 8).alias("p"))


def g14_random_walks(spark, folder):
    starts = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("walk_id"), F.concat(F.lit("C"), "c_custkey").alias("start")
    )
    found = walks.random_walks(flows(spark, folder), starts)
    return found.withColumn("path", F.array_join("path", ">"))


def g15_expected_visits(spark, folder):
    """From each nation over all trade edges."""
    starts = nation_nodes(spark, folder).select(F.col("id").alias("start"))
    found = graph.expected_visits(trade(spark, folder), starts)
    return found.select("start", "node", F.round("visits", 6).alias("visits"))


def g15_event_visits(spark, folder):
    steps = cut(event_steps(spark, folder))
    found = graph.expected_visits(steps, steps.select(F.col("src").alias("start")).distinct())
    return found.select("start", "node", F.round("visits", 6).alias("visits"))


def _scenarios(spark, folder):
    """One scenario per customer segment and nation pair with the largest number of customers."""
    segments = load(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.min("c_nationkey").alias("a"), F.max("c_nationkey").alias("b")
    )
    nations = load(spark, folder, "nation")
    start = nations.select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("start"))
    end = nations.select(F.col("n_nationkey").alias("b"), F.col("n_name").alias("end"))
    return segments.join(start, "a").join(end, "b").select(
        F.col("c_mktsegment").alias("name"), "start", "end", F.concat("start", F.lit(" to "), "end").alias("description")
    )


def g16_scenarios(spark, folder):
    found = paths.run_scenarios(_shared_edges(spark, folder), _scenarios(spark, folder), CUTOFF, 3)
    return found.select(
        "name", "description", F.array_join("best_path", ">").alias("best_path"), "best_probability", "hops", "n_paths",
        F.array_join("random_walk", ">").alias("random_walk"),
    )


def g17_node_metrics(spark, folder):
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder))
    return plans.node_metrics(g)


def s7_export_nodes(spark, folder):
    return sinks.export_nodes(graph.build_graph(
        nation_nodes(spark, folder).filter("description = 'Region 1'"), trade(spark, folder)).nodes)


def s7_export_links(spark, folder):
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder).select(
        "src", "dst", F.when(F.col("share") > 0.05, F.col("share")).alias("weight")))
    return sinks.export_links(g.edges)


def a1_summary(spark, folder):
    g = graph.build_graph(nation_nodes(spark, folder), whole_trade(spark, folder))
    ranks = pagerank.pagerank(g)
    rounded = ranks.select("id", F.round("pagerank", 8).alias("pagerank"))
    return plans.summary(load(spark, folder, "documents"), tables.label_table(spark), g, rounded, trained=False)


# --- SQL ---------------------------------------------------------------------

TRADE_SQL = """
trade AS (SELECT sn.n_name AS src, cn.n_name AS dst, sum(l_quantity) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey GROUP BY ALL),
shares AS (SELECT *, weight / sum(weight) OVER (PARTITION BY src) AS share FROM trade)"""

FLOWS_SQL = """
flows AS (
  SELECT 'C' || o_custkey AS src, 'S' || l_suppkey AS dst, sum(l_quantity) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL UNION ALL
  SELECT 'S' || s_suppkey, 'N' || s_nationkey, 1.0 FROM supplier UNION ALL
  SELECT 'N' || c_nationkey, 'C' || c_custkey, count(*) FROM customer JOIN orders ON o_custkey = c_custkey
  GROUP BY c_nationkey, c_custkey),
ids AS (SELECT 'C' || c_custkey AS id FROM customer UNION SELECT src FROM flows UNION SELECT dst FROM flows)"""

EVENTS_SQL = """
steps AS (SELECT src, dst, count(*) AS weight FROM (
  SELECT event_type AS src, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events)
  WHERE dst IS NOT NULL GROUP BY ALL)"""


def _rank_sql(nodes: str, edges: str) -> str:
    return f"""
ns AS (SELECT id, count(*) OVER () AS n FROM {nodes}),
es AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS p FROM {edges}),
pr AS (
  SELECT 0 AS it, id, n, 1.0::DOUBLE / n AS r, 1.0::DOUBLE AS d FROM ns
  UNION ALL
  SELECT it + 1, id, n, new, abs(new - r) FROM (
    SELECT s.it, o.id, o.n, o.r, 0.15 / o.n + 0.85 * (coalesce(got, 0) + sunk / o.n) AS new
    FROM pr o LEFT JOIN (SELECT dst, sum(r * p) AS got FROM pr JOIN es ON src = id GROUP BY dst) g ON g.dst = o.id
    CROSS JOIN (SELECT max(it) AS it, sum(d) AS moved,
      coalesce(sum(r) FILTER (WHERE id NOT IN (SELECT src FROM es)), 0) AS sunk FROM pr) s
    WHERE s.it < 100 AND s.moved >= o.n * 1e-6) steps),
ranks AS (SELECT id, r AS pagerank FROM pr WHERE it = (SELECT max(it) FROM pr))"""


def _paths_sql(pairs: str, top: int) -> str:
    """All simple paths, but for those that are already below the ``top``-th of the paths with one or two edges.

    No share is over 1, so a prefix never grows.
    """
    return f"""
hops AS (SELECT src, dst, share FROM shares WHERE src <> dst),
pairs AS (SELECT s AS start, e AS "end" FROM ({pairs}) AS pairs(s, e) WHERE s <> e),
short AS (SELECT start, "end", round(share, 6) AS p FROM pairs JOIN hops ON src = start AND dst = "end" UNION ALL
  SELECT start, "end", round(a.share * b.share, 6) FROM pairs JOIN hops a ON a.src = start JOIN hops b ON b.src = a.dst AND b.dst = "end"
  WHERE a.dst <> "end"),
floors AS (SELECT start, "end", min(p) AS worst FROM (
  SELECT *, row_number() OVER (PARTITION BY start, "end" ORDER BY p DESC) AS nth FROM short) WHERE nth <= {top}
  GROUP BY start, "end" HAVING count(*) = {top}),
walk AS (
  SELECT start, "end", start AS tail, [start] AS path, 1.0::DOUBLE AS p, coalesce(worst, 0) AS worst
  FROM pairs LEFT JOIN floors USING (start, "end")
  UNION ALL
  SELECT start, "end", dst, list_append(path, dst), p * share, worst FROM walk JOIN hops ON tail = src
  WHERE tail <> "end" AND len(path) <= {CUTOFF} AND NOT list_contains(path, dst) AND round(p * share, 6) >= worst),
ranked AS (SELECT start, "end", path, round(p, 6) AS probability,
    row_number() OVER (PARTITION BY start, "end" ORDER BY round(p, 6) DESC, path) AS rank FROM walk WHERE tail = "end")"""


ALL_PAIRS = "SELECT a.n_name, b.n_name FROM nation a, nation b"

SCENARIO_SQL = """
scenarios AS (SELECT c_mktsegment AS name, a.n_name AS start, b.n_name AS "end", a.n_name || ' to ' || b.n_name AS description
  FROM (SELECT c_mktsegment, min(c_nationkey) AS a, max(c_nationkey) AS b FROM customer GROUP BY c_mktsegment) s
  JOIN nation a ON s.a = a.n_nationkey JOIN nation b ON s.b = b.n_nationkey)"""


def _between_sql() -> str:
    squares, last = "", "d0"
    for i in range(1, 6):
        squares += f"""
d{i} AS (SELECT s, v, min(d) AS d FROM (SELECT * FROM {last} UNION ALL
  SELECT x.s, y.v, x.d + y.d FROM {last} x JOIN {last} y ON x.v = y.s) GROUP BY ALL),"""
        last = f"d{i}"
    return f"""
d0 AS (SELECT n_name AS s, n_name AS v, 0.0::DOUBLE AS d FROM nation UNION ALL SELECT src, dst, weight FROM trade),
{squares}
tight AS (SELECT a.s, src AS u, dst AS v FROM {last} a JOIN trade ON a.v = src JOIN {last} b ON b.s = a.s AND b.v = dst
  WHERE a.d + weight = b.d),
count_walks AS (SELECT n_name AS s, n_name AS v, 0 AS hop, 1.0::DOUBLE AS c FROM nation UNION ALL
  SELECT w.s, t.v, hop + 1, sum(c) FROM count_walks w JOIN tight t ON t.s = w.s AND t.u = w.v GROUP BY w.s, t.v, hop),
sigma AS (SELECT s, v, sum(c) AS c FROM count_walks GROUP BY s, v),
central AS (
  SELECT x.v AS id, sum(a.c * b.c / st.c) AS total
  FROM {last} x JOIN {last} y ON x.v = y.s JOIN {last} z ON z.s = x.s AND z.v = y.v AND x.d + y.d = z.d
  JOIN sigma a ON a.s = x.s AND a.v = x.v JOIN sigma b ON b.s = y.s AND b.v = y.v JOIN sigma st ON st.s = z.s AND st.v = z.v
  WHERE x.s <> x.v AND y.s <> y.v AND z.s <> z.v GROUP BY x.v),
between_all AS (SELECT n_name AS id, coalesce(total, 0) / ((SELECT count(*) - 1 FROM nation) * (SELECT count(*) - 2 FROM nation)) AS b
  FROM nation LEFT JOIN central ON id = n_name)"""


def _visits_sql(edges: str, starts: str) -> str:
    return f"""
es AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS p FROM {edges}),
mass AS (SELECT 0 AS t, s AS start, s AS node, 1.0::DOUBLE AS m FROM ({starts}) AS starts(s)
  UNION ALL SELECT t + 1, start, dst, sum(m * 0.85 * p) FROM mass JOIN es ON node = src WHERE t < 12 GROUP BY t, start, dst)
SELECT start, node, round(sum(m), 6) AS visits FROM mass GROUP BY ALL"""


def _uniform(step: str, purpose: str) -> str:
    return f"(('0x' || substr(md5(walk_id || '|' || ({step}) || '|{purpose}|42'), 1, 13))::BIGINT / 4503599627370496.0)"


def _walks_sql(edges: str, starts: str) -> str:
    """``walks`` (walk_id, n_moves, visited) from a table of edges and a query of (walk_id, start)."""
    return f"""
cdf AS (SELECT src, dst, (upto - weight) / total AS lo, upto / total AS hi FROM (
  SELECT *, sum(weight) OVER (PARTITION BY src ORDER BY md5(dst), dst) AS upto, sum(weight) OVER (PARTITION BY src) AS total FROM {edges})),
steps AS (SELECT 0 AS t, walk_id, node, [node] AS path FROM ({starts}) AS starts(walk_id, node)
  UNION ALL SELECT t + 1, walk_id, dst, list_append(path, dst) FROM steps JOIN cdf ON src = node
  WHERE t < 12 AND {_uniform('t + 1', 'stop')} >= 0.15
    AND {_uniform('t + 1', 'move')} >= lo AND {_uniform('t + 1', 'move')} < hi),
walks AS (SELECT walk_id, n_moves, array_to_string(list_filter(path, lambda x, i: list_position(path, x) = i), '>') AS visited
  FROM (SELECT walk_id, max(t) AS n_moves, max_by(path, t) AS path FROM steps GROUP BY walk_id))"""


WALKS_SQL = f"""
WITH RECURSIVE {FLOWS_SQL}, {_walks_sql('flows', "SELECT c_custkey, 'C' || c_custkey FROM customer")}
SELECT walk_id, n_moves::INT AS n_moves, visited AS path FROM walks"""

QUERIES = {
    "g1_build_graph": g1_build_graph,
    "g2_last_edge": g2_last_edge,
    "g3_expand_to_members": g3_expand_to_members,
    "g4_degrees": g4_degrees,
    "g5_density": g5_density,
    "g6_pagerank": g6_pagerank,
    "g6_pagerank_converged": g6_pagerank_converged,
    "g7_top_nodes": g7_top_nodes,
    "g8_betweenness": g8_betweenness,
    "g9_g10_g12_ranked_paths": g9_g12_ranked_paths,
    "g11_path_steps": g11_path_steps,
    "g13_transition_probabilities": g13_transition_probabilities,
    "g13_event_transitions": g13_event_transitions,
    "g14_random_walks": g14_random_walks,
    "g15_expected_visits": g15_expected_visits,
    "g15_event_visits": g15_event_visits,
    "g16_scenarios": g16_scenarios,
    "g17_node_metrics": g17_node_metrics,
    "s7_export_nodes": s7_export_nodes,
    "s7_export_links": s7_export_links,
    "a1_summary": a1_summary,
}

_NATION_IDS = "(SELECT n_name AS id FROM nation)"
_RANKED = f"WITH RECURSIVE {TRADE_SQL}, {_rank_sql(_NATION_IDS, 'trade')} "

ORACLES = {
    "g1_build_graph": f"""
WITH {TRADE_SQL} SELECT id, description, type FROM (SELECT src AS id FROM trade UNION SELECT dst FROM trade) LEFT JOIN
  (SELECT n_name AS id, 'Region 1' AS description, 'nation' AS type FROM nation WHERE n_regionkey = 1) USING (id)""",
    "g2_last_edge": """
SELECT 'C' || o_custkey AS src, o_orderpriority AS dst, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS weight
FROM orders GROUP BY ALL""",
    "g3_expand_to_members": f"""
WITH {TRADE_SQL},
regions AS (SELECT a.n_regionkey AS src, b.n_regionkey AS dst, sum(weight) AS weight FROM trade
  JOIN nation a ON a.n_name = src JOIN nation b ON b.n_name = dst WHERE a.n_regionkey < b.n_regionkey GROUP BY ALL)
SELECT a.n_name AS src, b.n_name AS dst, 0.4 AS weight, 'intra_tactic' AS edge_type
FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name UNION ALL
SELECT a.n_name, b.n_name, weight, 'cross_tactic' FROM regions
JOIN nation a ON a.n_regionkey = src JOIN nation b ON b.n_regionkey = dst""",
    "g4_degrees": f"""
WITH {FLOWS_SQL} SELECT id, (SELECT count(*) FROM flows WHERE dst = id) AS in_degree,
  (SELECT count(*) FROM flows WHERE src = id) AS out_degree FROM ids""",
    "g5_density": f"""
WITH {FLOWS_SQL}, c AS (SELECT (SELECT count(*) FROM ids) AS n_nodes, (SELECT count(*) FROM flows) AS n_edges)
SELECT n_nodes, n_edges, round(n_edges / (n_nodes * (n_nodes - 1)), 4) AS density FROM c""",
    "g6_pagerank": f"WITH RECURSIVE {FLOWS_SQL}, {_rank_sql('ids', 'flows')} SELECT id, round(pagerank, 8) AS pagerank FROM ranks",
    "g6_pagerank_converged": _RANKED + "SELECT id, round(pagerank, 4) AS pagerank FROM ranks",
    "g7_top_nodes": _RANKED + "SELECT id, round(pagerank, 8) AS pagerank FROM ranks ORDER BY 2 DESC, 1 LIMIT 5",
    "g8_betweenness": f"WITH RECURSIVE {TRADE_SQL}, {_between_sql()} SELECT id, round(b, 6) AS betweenness FROM between_all",
    "g9_g10_g12_ranked_paths": f"""
WITH RECURSIVE {TRADE_SQL}, {_paths_sql(ALL_PAIRS, 5)}
SELECT start, "end", rank::INT AS rank, array_to_string(path, '>') AS path, probability, len(path)::INT AS n_nodes,
  (len(path) - 1)::INT AS n_edges FROM ranked WHERE rank <= 5""",
    "g11_path_steps": f"""
WITH RECURSIVE {TRADE_SQL}, {_paths_sql(ALL_PAIRS, 2)}
SELECT start, "end", rank::INT AS rank, i::INT AS step, path[i] AS src, path[i + 1] AS dst
FROM (SELECT *, unnest(range(1, len(path))) AS i FROM ranked WHERE rank <= 2)""",
    "g13_transition_probabilities": f"""
WITH {FLOWS_SQL} SELECT src, dst, round(weight / sum(weight) OVER (PARTITION BY src), 8) AS p FROM flows""",
    "g13_event_transitions": f"""
WITH {EVENTS_SQL} SELECT src, dst, round(weight / sum(weight) OVER (PARTITION BY src), 8) AS p FROM steps""",
    "g14_random_walks": WALKS_SQL,
    "g15_expected_visits": f"WITH RECURSIVE {TRADE_SQL}, {_visits_sql('trade', 'SELECT n_name FROM nation')}",
    "g15_event_visits": f"WITH RECURSIVE {EVENTS_SQL}, {_visits_sql('steps', 'SELECT DISTINCT src FROM steps')}",
    "g16_scenarios": f"""
WITH RECURSIVE {TRADE_SQL}, {SCENARIO_SQL}, {_paths_sql('SELECT DISTINCT start, "end" FROM scenarios', 3)}, 
hop_shares AS (SELECT src, dst, share AS weight FROM shares), {_walks_sql('hop_shares', 'SELECT name, start FROM scenarios')},
best AS (SELECT start, "end", count(*) AS n_paths, max_by(path, -rank) AS path, max_by(probability, -rank) AS p
  FROM ranked WHERE rank <= 3 GROUP BY ALL)
SELECT name, description, coalesce(array_to_string(path, '>'), '') AS best_path, coalesce(p, 0) AS best_probability,
  coalesce(len(path), 0)::INT AS hops, coalesce(n_paths, 0)::INT AS n_paths, visited AS random_walk
FROM scenarios LEFT JOIN best USING (start, "end") LEFT JOIN walks ON walk_id = name""",
    "g17_node_metrics": f"""
WITH RECURSIVE {TRADE_SQL}, {_rank_sql(_NATION_IDS, 'trade')}, {_between_sql()}
SELECT id, 'Region ' || n_regionkey AS description, round(pagerank, 4) AS pagerank, round(b, 4) AS betweenness
FROM ranks JOIN between_all USING (id) JOIN nation ON n_name = id""",
    "s7_export_nodes": f"""
WITH {TRADE_SQL} SELECT id, coalesce(description, '') AS description, coalesce(type, 'tactic') AS type
FROM (SELECT src AS id FROM trade UNION SELECT dst FROM trade) LEFT JOIN
  (SELECT n_name AS id, 'Region 1' AS description, 'nation' AS type FROM nation WHERE n_regionkey = 1) USING (id)""",
    "s7_export_links": f"""
WITH {TRADE_SQL} SELECT src AS source, dst AS target, round(CASE WHEN share > 0.05 THEN share ELSE 0.5 END, 3) AS weight FROM shares""",
    "a1_summary": _RANKED + f"""
SELECT (SELECT count(*) FROM documents) AS total_reports, {len(fixed.LABELS)}::BIGINT AS total_tactics,
  (SELECT count(*) FROM nation) AS graph_nodes, (SELECT count(*) FROM trade) AS graph_edges,
  (SELECT string_agg(id, ', ' ORDER BY p DESC, id) FROM (SELECT id, round(pagerank, 8) AS p FROM ranks ORDER BY 2 DESC, 1 LIMIT 5))
    AS top_critical, false AS supervised_ready""",
}
