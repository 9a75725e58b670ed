"""Joining cluster results back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.operators.skew import lookup_join


def profile_name(cluster: Column) -> Column:
    """The given name of a cluster, or ``Cluster-<id>``."""
    return F.coalesce("name", F.concat(F.lit("Cluster-"), cluster.cast("string")))


def profiles(
    docs: DataFrame, key: str, title: str, km: DataFrame, hac: DataFrame, names: DataFrame, keywords: DataFrame
) -> DataFrame:
    """(report_id, title, kmeans_cluster, hac_cluster, actor_profile, top_keywords).

    ``km`` and ``hac`` are (key, cluster); ``names`` is (cluster, name) and
    ``keywords`` (cluster, top_keywords), both with one row per cluster.
    """
    both = km.select(key, F.col("cluster").alias("kmeans_cluster")).join(
        hac.select(key, F.col("cluster").alias("hac_cluster")), key
    )
    per_cluster = keywords.join(names, "cluster", "full").withColumnRenamed("cluster", "kmeans_cluster")
    rows = docs.select(key, title).join(both, key)
    return lookup_join(rows, per_cluster, "kmeans_cluster", how="left").select(
        F.col(key).alias("report_id"), F.col(title).alias("title"), "kmeans_cluster", "hac_cluster",
        profile_name(F.col("kmeans_cluster")).alias("actor_profile"),
        F.coalesce("top_keywords", F.array().cast("array<string>")).alias("top_keywords"),
    )


def scatter(points: DataFrame, key: str, title: str, names: DataFrame) -> DataFrame:
    """(id, title, x, y, cluster, profile) from rows with x, y and cluster."""
    return lookup_join(points, names, "cluster", how="left").select(
        F.col(key).alias("id"), F.col(title).alias("title"), "x", "y", "cluster",
        profile_name(F.col("cluster")).alias("profile"),
    )


def node_metrics(nodes: DataFrame, ranks: DataFrame, central: DataFrame) -> DataFrame:
    """(id, description, pagerank, betweenness); missing measures are 0, 4 decimals."""
    def measure(name: str) -> Column:
        return F.round(F.coalesce(name, F.lit(0.0)), 4).alias(name)

    return nodes.select("id", "description").join(ranks, "id", "left").join(central, "id", "left").select(
        "id", "description", measure("pagerank"), measure("betweenness")
    )
