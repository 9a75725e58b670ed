"""Best simple paths between pairs of nodes, by the product of edge weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from inkgraph.functions.text import adjacent_pairs
from inkgraph.operators.graph import weight_or_default
from inkgraph.operators.skew import Hot, find_hot, spread_join
from inkgraph.operators.walks import random_walks
from inkgraph.session import cut

PLACES = 6      # probabilities are compared after rounding, then by path
SLACK = 1 + 1e-9    # a product may come out a little larger in another order


def _best_to_end(edges: DataFrame, ends: DataFrame, cutoff: int, hot: Hot) -> DataFrame:
    """(end, node, best): the greatest product of weights of any walk from a node to an end with at most
    0, 1, 2, ... edges, up to ``cutoff``; 0 where there is no such walk.  One row per end and node near enough.
    """
    last = F.element_at("best", -1)
    known = cut(ends.select("end", F.col("end").alias("node"), F.array(F.lit(1.0)).alias("best")))
    for hop in range(1, cutoff + 1):
        reached = known.filter(last > 0).select("end", F.col("node").alias("dst"), last.alias("further"))
        found = (
            spread_join(edges, reached, "dst", by=["src"], hot=hot).filter(F.col("src") != F.col("end"))
            .groupBy("end", F.col("src").alias("node")).agg(F.max(F.col("w") * F.col("further")).alias("found"))
        )
        grown = known.join(found, ["end", "node"], "full").withColumn(
            "best", F.coalesce("best", F.array_repeat(F.lit(0.0), hop))
        )
        known = cut(grown.select("end", "node", F.concat(
            "best", F.array(F.greatest(last, F.coalesce("found", F.lit(0.0))))).alias("best")))
        if known.filter(F.get("best", F.lit(hop)) > F.get("best", F.lit(hop - 1))).isEmpty():
            break       # longer walks are no better
    return known


def _best(paths: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("start", "end").orderBy(F.desc("probability"), "path")
    return paths.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_paths(edges: DataFrame, pairs: DataFrame, cutoff: int = 10, top: int = 5) -> DataFrame:
    """(start, end, rank, path, probability, n_nodes, n_edges) for each (start, end) of ``pairs``.

    Paths grow by one edge per round, for all pairs together.  A prefix is
    dropped only if it cannot matter: if it times the best walk from its last
    node to the end, with as many edges as are left, is 0 or stays below the
    ``top``-th path already found.  The result is therefore exact.  Many
    prefixes that end in one node are split by adaptive skew joins.
    """
    edges = cut(
        edges.filter("src <> dst").select("src", "dst", weight_or_default(F.col("weight")).alias("w"))
    )
    out_hot, in_hot = find_hot(edges, "src"), find_hot(edges, "dst")
    pairs = pairs.select("start", "end").filter(F.col("start") != F.col("end")).distinct()
    onward = _best_to_end(edges, pairs.select("end").distinct(), cutoff, in_hot)

    frontier = pairs.select(
        "start", "end", F.col("start").alias("tail"), F.array("start").alias("path"), F.lit(1.0).alias("p")
    )
    done = frontier.limit(0).select("start", "end", "path", F.col("p").alias("probability"))
    for used in range(1, cutoff + 1):
        left = F.least(F.lit(cutoff - used), F.size("best") - 1)
        grown = (
            spread_join(edges, frontier.withColumnRenamed("tail", "src"), "src", by=["dst"], hot=out_hot)
            .filter(~F.array_contains("path", F.col("dst")))
            .join(onward.withColumnRenamed("node", "dst"), ["end", "dst"])
            .withColumn("onward", F.get("best", left))
            .filter((F.col("onward") > 0) | (F.col("dst") == F.col("end")))
            .select("start", "end", F.col("dst").alias("tail"), F.concat("path", F.array("dst")).alias("path"),
                    (F.col("p") * F.col("w")).alias("p"), "onward")
        )
        grown = cut(grown)
        complete = grown.filter(F.col("tail") == F.col("end")).select(
            "start", "end", "path", F.round("p", PLACES).alias("probability")
        )
        done = cut(_best(done.unionByName(complete), top).select("start", "end", "path", "probability"))
        bound = done.groupBy("start", "end").agg(F.count("*").alias("n"), F.min("probability").alias("worst")) \
            .filter(F.col("n") >= top).select("start", "end", "worst")
        at_most = F.round(F.col("p") * F.col("onward") * SLACK, PLACES)
        frontier = (
            grown.filter(F.col("tail") != F.col("end"))
            .join(bound, ["start", "end"], "left")
            .filter(F.col("worst").isNull() | (at_most >= F.col("worst")))
            .drop("worst", "onward")
        )
        if frontier.isEmpty():
            break
    return _best(done, top).select(
        "start", "end", "rank", "path", "probability",
        F.size("path").alias("n_nodes"), (F.size("path") - 1).alias("n_edges"),
    )


def path_steps(paths: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """Neighbouring nodes of each path: keys, step, src, dst."""
    return paths.select(*keys, F.posexplode(adjacent_pairs(F.col(path))).alias("pos", "e")).select(
        *keys, (F.col("pos") + 1).alias("step"), F.col("e.left").alias("src"), F.col("e.right").alias("dst")
    )


def run_scenarios(
    edges: DataFrame, scenarios: DataFrame, cutoff: int = 10, top: int = 3, seed: int = 42
) -> DataFrame:
    """Each named scenario with its best path, the list of its top paths (empty if there is none) and one random walk."""
    found = ranked_paths(edges, scenarios, cutoff, top)
    entry = F.struct("rank", "path", "probability", F.col("n_nodes").alias("length"))
    lists = found.groupBy("start", "end").agg(F.array_sort(F.collect_list(entry)).alias("p"))   # at most ``top``
    walked = random_walks(edges, scenarios.select("name", "start"), "name", seed=seed)
    best = F.get("p", F.lit(0))
    nothing = F.array().cast(lists.schema["p"].dataType)
    return scenarios.join(lists, ["start", "end"], "left").join(
        walked.select("name", F.col("path").alias("random_walk")), "name", "left"
    ).select(
        "name", "description", "start", "end",
        F.coalesce(best["path"], F.array().cast("array<string>")).alias("best_path"),
        F.coalesce(best["probability"], F.lit(0.0)).alias("best_probability"),
        F.coalesce(best["length"], F.lit(0)).alias("hops"),
        F.coalesce(F.size("p"), F.lit(0)).alias("n_paths"),
        F.transform(F.coalesce("p", nothing), lambda e: F.struct(
            e["path"].alias("path"), e["probability"].alias("probability"), e["length"].alias("length")
        )).alias("all_paths"),
        "random_walk",
    )
