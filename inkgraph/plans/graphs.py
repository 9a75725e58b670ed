"""Measures and summaries of a whole graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkgraph.operators import betweenness, graph, pagerank, profiles


def node_metrics(g: graph.Graph, cost: str = "weight") -> DataFrame:
    """(id, description, pagerank, betweenness)."""
    return profiles.node_metrics(g.nodes, pagerank.pagerank(g), betweenness.betweenness(g, cost))


def summary(reports: DataFrame, labels: DataFrame, g: graph.Graph, ranks: DataFrame, trained: bool, top: int = 5) -> DataFrame:
    """One row: how many reports, labels, nodes and edges; the top nodes; whether a model is trained."""
    best = pagerank.top_nodes(ranks, top).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("pagerank")).alias("key"), "id"))).alias("t")      # ``top`` rows
    ).select(F.array_join(F.transform("t", lambda e: e["id"]), ", ").alias("top_critical"))
    return graph.size_and_density(g).select(
        reports.agg(F.count("*").alias("n")).scalar().alias("total_reports"),
        labels.agg(F.count("*").alias("n")).scalar().alias("total_tactics"),
        F.col("n_nodes").alias("graph_nodes"), F.col("n_edges").alias("graph_edges"),
        best.scalar().alias("top_critical"), F.lit(trained).alias("supervised_ready"),
    )
