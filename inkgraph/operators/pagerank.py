"""Weighted PageRank with the rank of sinks spread over all nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkgraph.operators.graph import Graph, source_totals, transition_probabilities, weight_or_default
from inkgraph.operators.skew import BROADCAST_ROWS, find_hot
from inkgraph.session import cut, placed


ROUNDS_PER_CUT = 5


def pagerank(graph: Graph, damping: float = 0.85, max_rounds: int = 100, tol: float = 1e-6) -> DataFrame:
    """(id, pagerank).  Stops when ranks move by less than ``n * tol`` in total.

    Each round joins ranks to the outgoing edges and sums per target, map-side
    first.  Ranks counted to be few are broadcast; otherwise edges are partitioned
    by source once and only ranks are exchanged.  The change and the rank held by
    sinks come back as two numbers.  A round is cached until the next one is done,
    so a lost executor costs at most ``ROUNDS_PER_CUT`` rounds for its part.
    """
    spark = graph.edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = cut(source_totals(graph.edges))
    sources = totals.select(F.col("src").alias("id"), F.lit(True).alias("moves_on"))
    nodes = cut(graph.nodes.select("id").distinct().join(sources, "id", "left"))
    n, sinks = nodes.agg(F.count("*"), F.count_if(F.col("moves_on").isNull())).first()
    if n == 0:
        return nodes.select("id", F.lit(0.0).alias("pagerank"))
    on_sinks = sinks / n
    few_nodes = n <= BROADCAST_ROWS
    if few_nodes:
        moves = cut(transition_probabilities(graph.edges).repartition(parts, "src", "dst"))     # even, whatever the hubs
    else:       # edges are exchanged once, to where the rounds need them; totals come to them there
        hot = find_hot(graph.edges, "src")
        moves = placed(spark, lambda: (
            hot.spread(graph.edges.select("src", "dst", weight_or_default(F.col("weight")).alias("w")), "src", by=["dst"])
            .repartition(parts, "src", "salt")
            .join(hot.copy(totals, "src"), ["src", "salt"])
            .select("src", "salt", "dst", (F.col("w") / F.col("total")).alias("p"))
        ), "src", "salt")
    ranks = before = nodes.withColumn("rank", F.lit(1.0 / n))
    for done in range(1, max_rounds + 1):
        senders = ranks.select(F.col("id").alias("src"), "rank")
        joined = (
            moves.join(F.broadcast(senders), "src") if few_nodes
            else moves.join(hot.copy(senders, "src"), ["src", "salt"])
        )
        sent = (
            joined.groupBy("dst").agg(F.sum(F.col("rank") * F.col("p")).alias("got"))
            .withColumnRenamed("dst", "id")
        )
        base = (1 - damping) / n + damping * on_sinks / n
        new = F.lit(base) + damping * F.coalesce("got", F.lit(0.0))
        stepped = (
            ranks.withColumnRenamed("rank", "old").join(sent, "id", "left")
            .select("id", "moves_on", new.alias("rank"), F.abs(new - F.col("old")).alias("moved"))
        )
        stepped = cut(stepped) if done % ROUNDS_PER_CUT == 0 else stepped.persist()
        moved, on_sinks = stepped.agg(
            F.sum("moved"), F.coalesce(F.sum(F.when(F.col("moves_on").isNull(), F.col("rank"))), F.lit(0.0))
        ).first()
        before.unpersist()
        before, ranks = stepped, stepped.select("id", "moves_on", "rank")
        if moved < n * tol:
            break
    ranks = cut(ranks)
    before.unpersist()
    return ranks.select("id", F.col("rank").alias("pagerank"))


def top_nodes(ranks: DataFrame, top: int = 5) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), "id").limit(top)
