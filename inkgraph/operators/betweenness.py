"""Weighted betweenness: least-cost distances, path counts, back-propagated shares.

The state is one row per (source, node) of one batch of sources; the sources
of a batch advance together, one round per additional edge, and the shares of
all batches are added.  So at most ``batch_sources`` x nodes rows are held at
once, whatever the graph.  Costs must be positive, so that edges lying on
least-cost paths form no cycle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from inkgraph.operators.graph import Graph
from inkgraph.operators.skew import Hot, find_hot, spread_join
from inkgraph.session import cut

BATCH_SOURCES = 512     # sources whose (source, node) state is held at once


def _distances(edges: DataFrame, sources: DataFrame, hot: Hot) -> DataFrame:
    """(s, v, d): least cost from each source; only nodes that improved send again."""
    state = sources.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0.0).alias("d"),
                           F.lit(True).alias("better"))
    while True:
        active = state.filter("better").select("s", F.col("v").alias("src"), "d")
        reached = spread_join(edges, active, "src", by=["dst"], hot=hot).select(
            "s", F.col("dst").alias("v"), (F.col("d") + F.col("cost")).alias("d"), F.lit(None).cast("double").alias("old")
        )
        known = state.select("s", "v", "d", F.col("d").alias("old"))
        merged = known.unionByName(reached).groupBy("s", "v").agg(F.min("d").alias("d"), F.max("old").alias("old"))
        better = F.col("old").isNull() | (F.col("d") < F.col("old"))
        state = cut(merged.select("s", "v", "d", better.alias("better")))
        if state.filter("better").isEmpty():
            return state.select("s", "v", "d")


def _levels(first: DataFrame, step) -> list[DataFrame]:
    """Repeat ``step`` until nothing is left, each level materialised."""
    levels = [first]
    while not levels[-1].isEmpty():
        levels.append(cut(step(levels[-1])))
    return levels


def _sum_levels(levels: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    return reduce(DataFrame.unionByName, levels).groupBy(*keys).agg(F.sum(value).alias(value))


def _through(edges: DataFrame, batch: DataFrame, hot: Hot) -> DataFrame:
    """(v, x): the summed shares of the sources in ``batch`` on each inner node."""
    dist = _distances(edges, batch, hot)
    tight = (
        spread_join(edges, dist.select("s", F.col("v").alias("src"), F.col("d").alias("du")), "src", by=["dst"], hot=hot)
        .join(dist.select("s", F.col("v").alias("dst"), F.col("d").alias("dv")), ["s", "dst"])
        .filter(F.col("du") + F.col("cost") == F.col("dv"))
        .select("s", F.col("src").alias("u"), F.col("dst").alias("v"))
    )
    tight = cut(tight)

    start = dist.filter("s = v").select("s", "v", F.lit(1.0).alias("paths"))
    counts = _levels(start, lambda level: level.withColumnRenamed("v", "u").join(tight, ["s", "u"])
                     .groupBy("s", "v").agg(F.sum("paths").alias("paths")))
    sigma = cut(_sum_levels(counts, ["s", "v"], "paths"))

    share = cut(
        tight.join(sigma.select("s", F.col("v").alias("u"), F.col("paths").alias("pu")), ["s", "u"])
        .join(sigma.select("s", "v", F.col("paths").alias("pv")), ["s", "v"])
        .select("s", "u", "v", (F.col("pu") / F.col("pv")).alias("share"))
    )
    ends = sigma.filter("s <> v").select("s", "v", F.lit(1.0).alias("x"))
    back = _levels(ends, lambda level: level.join(share, ["s", "v"])
                   .groupBy("s", F.col("u")).agg(F.sum(F.col("x") * F.col("share")).alias("x"))
                   .withColumnRenamed("u", "v"))
    return cut(reduce(DataFrame.unionByName, back[1:], ends.limit(0)).filter("s <> v").groupBy("v").agg(F.sum("x").alias("x")))


def betweenness(graph: Graph, cost: str = "weight", sources: DataFrame | None = None,
                batch_sources: int = BATCH_SOURCES) -> DataFrame:
    """(id, betweenness), normalised by (n - 1)(n - 2).

    ``cost`` is an expression over the edge columns.  ``sources`` may restrict
    the starting nodes, which makes the result a partial sum.  Sources are taken
    in batches of about ``batch_sources`` (by a hash of the id), one after another.
    """
    edges = cut(graph.edges.select("src", "dst", F.expr(cost).cast("double").alias("cost")).filter("src <> dst"))
    if not edges.filter("cost is null or cost <= 0").isEmpty():
        raise ValueError("costs have to be positive")
    hot = find_hot(edges, "src")
    nodes = graph.nodes.select("id")
    starts = cut((nodes if sources is None else sources.select("id")).distinct())
    batches = max(1, -(-starts.count() // batch_sources))
    starts = starts.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)))
    parts = [_through(edges, starts.filter(F.col("batch") == b).select("id"), hot) for b in range(batches)]
    through = reduce(DataFrame.unionByName, parts).groupBy("v").agg(F.sum("x").alias("x"))

    n = nodes.count()
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return nodes.join(through.withColumnRenamed("v", "id"), "id", "left").select(
        "id", (F.coalesce("x", F.lit(0.0)) * scale).alias("betweenness")
    )
