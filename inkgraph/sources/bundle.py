"""Nested JSON bundles of typed objects, and the four tables in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkgraph import schemas
from inkgraph import fixed_values as fixed
from inkgraph.functions.arrays import field_list, first_field, joined, or_empty, unnest
from inkgraph.functions.text import clean_text, preview


def read_bundles(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Bundle files, one JSON document each (or one per line, which can be split further)."""
    return spark.read.schema(schemas.BUNDLE).option("multiLine", not one_per_line).json(path)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Objects stored one per line, the splittable form for large collections."""
    return spark.read.schema(schemas.OBJECT).json(path).select(F.struct("*").alias("o"))


def parse_bundles(lines: DataFrame, column: str = "value") -> DataFrame:
    """Bundles held as JSON text in a column."""
    return lines.select(F.from_json(column, schemas.BUNDLE).alias("bundle")).select("bundle.*")


def explode_objects(bundles: DataFrame) -> DataFrame:
    return unnest(bundles, "objects", "o")


def _of_type(objects: DataFrame, kind: str) -> DataFrame:
    return objects.filter(F.col("o.type") == kind)


def _text(field: str) -> Column:
    return or_empty(F.col(f"o.{field}"))


def tactics(objects: DataFrame) -> DataFrame:
    return _of_type(objects, fixed.TACTIC_TYPE).select(
        first_field(F.col("o.external_references"), "external_id").alias("id"),
        _text("name").alias("name"),
        _text("description").alias("description"),
        _text("x_mitre_shortname").alias("short_name"),
    )


def _up_to(text: Column, chars: int | None) -> Column:
    return text if chars is None else preview(text, chars)


def techniques(objects: DataFrame, description_chars: int | None = None, detection_chars: int | None = None) -> DataFrame:
    """Whole texts, unless a number of characters to keep is asked for."""
    return _of_type(objects, fixed.TECHNIQUE_TYPE).select(
        first_field(F.col("o.external_references"), "external_id").alias("id"),
        _text("id").alias("stix_id"),
        _text("name").alias("name"),
        _up_to(_text("description"), description_chars).alias("description"),
        joined(field_list(F.col("o.kill_chain_phases"), "phase_name")).alias("tactics"),
        joined(F.col("o.x_mitre_platforms")).alias("platforms"),
        F.coalesce(F.col("o.x_mitre_is_subtechnique"), F.lit(False)).alias("is_subtechnique"),
        _up_to(_text("x_mitre_detection"), detection_chars).alias("detection"),
        joined(F.col("o.x_mitre_data_sources")).alias("data_sources"),
    )


def groups(objects: DataFrame, description_chars: int | None = None) -> DataFrame:
    return _of_type(objects, fixed.GROUP_TYPE).select(
        _text("id").alias("stix_id"),
        _text("name").alias("name"),
        joined(F.col("o.aliases")).alias("aliases"),
        _up_to(_text("description"), description_chars).alias("description"),
    )


def relationships(objects: DataFrame) -> DataFrame:
    return _of_type(objects, fixed.RELATIONSHIP_TYPE).select(
        _text("source_ref").alias("source_ref"),
        _text("target_ref").alias("target_ref"),
        _text("relationship_type").alias("relationship_type"),
    )


def bundle_tables(bundles: DataFrame) -> dict[str, DataFrame]:
    """The four tables; each scans only the fields it needs."""
    objects = explode_objects(bundles)
    return {
        "tactics": tactics(objects),
        "techniques": techniques(objects),
        "groups": groups(objects),
        "relationships": relationships(objects),
    }


def preprocess_techniques(table: DataFrame) -> DataFrame:
    """Cleaned texts, the text to analyse, and only rows with a technique id."""
    return table.filter(F.col("id").rlike(r"^T\d+")).withColumns({
        "clean_description": clean_text(F.col("description")),
        "clean_detection": clean_text(F.col("detection")),
        "text_for_nlp": F.concat("name", F.lit(". "), clean_text(F.col("description"))),
    })
