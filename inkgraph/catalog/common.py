"""Table loading and shared SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkgraph.functions import text as tx


def load(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A table; ``spread_by`` redistributes it if its files give fewer tasks than there are cores.

    Large inputs have far more splits than cores and are read as they are.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, spread_by)
    return df


def q(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_clean(text: str) -> str:
    expr = f"coalesce({text}, '')"
    for pattern, by in ((tx.CITATION, ""), (tx.URL, ""), (tx.WIKI_LINK, "\\1"), (tx.UNWANTED, " "), (tx.BLANKS, " ")):
        expr = f"regexp_replace({expr}, {q(pattern)}, {q(by)}, 'g')"
    return f"trim({expr})"


def sql_keywords(words: dict[str, list[str]]) -> str:
    """A VALUES list (label, label_ord, keyword)."""
    rows = ", ".join(
        f"({q(label)}, {position}, {q(word)})" for position, label in enumerate(words) for word in words[label]
    )
    return f"(VALUES {rows}) AS k(label, label_ord, keyword)"


def sql_terms(table: str, key: str) -> str:
    """CTEs ``toks`` (key, t: list) and ``terms`` (key, term), one row per occurrence."""
    return f"""
toks AS (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), {q(tx.TOKEN)}) AS t FROM {table}),
terms AS (
  SELECT {key}, unnest(t) AS term FROM toks
  UNION ALL
  SELECT {key}, t[i] || ' ' || t[i + 1] AS term
  FROM (SELECT {key}, t, unnest(range(1, len(t))) AS i FROM toks))"""
