"""Writers: CSV and Parquet tables, JSON lines, and the graph export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkgraph import fixed_values as fixed


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text is written unchanged: blanks at either end stay, quotes are doubled."""
    df.write.mode(mode).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line; missing values are kept as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_tables(tables: dict[str, DataFrame], folder: str, mode: str = "errorifexists") -> None:
    for name, table in tables.items():
        write_csv(table, f"{folder}/{name}", mode)


def export_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "id",
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("type", F.lit(fixed.NODE_TYPE)).alias("type"),
    )


def export_links(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.col("src").alias("source"),
        F.col("dst").alias("target"),
        F.round(F.coalesce("weight", F.lit(fixed.DEFAULT_WEIGHT)), 3).alias("weight"),
    )


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Nodes and links as two line-wise JSON tables, so size does not matter."""
    write_json(export_nodes(nodes), f"{folder}/nodes", mode)
    write_json(export_links(edges), f"{folder}/links", mode)
