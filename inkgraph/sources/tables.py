"""Tables at rest and the small given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from inkgraph import fixed_values as fixed
from inkgraph import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def sample_reports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.SAMPLE_REPORTS, schemas.REPORTS)


def label_table(spark: SparkSession, labels: list[str] | None = None) -> DataFrame:
    rows = list(enumerate(labels if labels is not None else fixed.LABELS))
    return spark.createDataFrame([(label, position) for position, label in rows], schemas.LABELS)


def keyword_table(spark: SparkSession, keywords: dict[str, list[str]] | None = None) -> DataFrame:
    words = keywords if keywords is not None else fixed.KEYWORDS
    return spark.createDataFrame(
        [(label, position, word) for position, label in enumerate(words) for word in words[label]],
        schemas.KEYWORDS,
    )


def profile_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.PROFILE_NAMES.items()), schemas.PROFILE_NAMES)


def graph_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(name, text, fixed.NODE_TYPE) for name, text in fixed.NODE_DESCRIPTIONS.items()], schemas.NODES
    )


def graph_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, t, w, w) for s, t, w in fixed.GRAPH_EDGES], schemas.EDGES)


def class_members(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(group, key, name) for group, members in fixed.CLASS_MEMBERS.items() for key, name in members],
        schemas.MEMBERS,
    )


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.SCENARIOS, schemas.SCENARIOS)
