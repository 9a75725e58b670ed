"""Bundles of typed objects made from the given tables, un-nested, cleaned and labelled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkgraph import fixed_values as fixed
from inkgraph import schemas
from inkgraph.catalog.common import load, q, sql_clean
from inkgraph.operators import labels
from inkgraph.session import cut, scratch_folder
from inkgraph.sources import bundle, sinks, tables

PHASES = {"en": ["execution", "initial-access"], "fr": ["command-and-control"], "de": ["unknown-phase"], "es": []}


def _strings(*items) -> Column:
    return F.array(*items).cast("array<string>")


def _line(**fields: Column) -> Column:
    """One bundle with one object, as JSON text."""
    return F.to_json(F.struct(F.array(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("objects"))).alias("value")


def _reference(value: Column) -> Column:
    return F.array(F.struct(value.alias("external_id")))


def _no_reference() -> Column:
    return F.array().cast("array<struct<external_id:string>>")


def bundle_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON bundles: nations as tactics, documents as techniques, suppliers as groups, orders as relationships."""
    nations = load(spark, folder, "nation").select(_line(
        type=F.lit(fixed.TACTIC_TYPE), name=F.col("n_name"),
        description=F.concat(F.lit("Region "), "n_regionkey"), x_mitre_shortname=F.lower("n_name"),
        external_references=F.when(F.col("n_regionkey") == 0, _no_reference()).otherwise(
            _reference(F.concat(F.lit("TA"), "n_nationkey"))),
    ))
    docs = load(spark, folder, "documents", spread_by="doc_id")
    number = (F.col("doc_id") + 1000).cast("string")
    lang = F.col("lang")
    techniques = docs.select(_line(
        type=F.lit(fixed.TECHNIQUE_TYPE), id=F.concat(F.lit("doc-"), "doc_id"), name=F.col("source"),
        description=F.concat(F.lit("(Citation: "), "source", F.lit(") https://"), "source", F.lit(".example.org [["),
                             "lang", F.lit("]] "), "text"),
        external_references=F.when(lang == "es", _no_reference()).otherwise(_reference(
            F.concat(F.when(lang == "de", "TA").otherwise("T"), number, F.when(lang == "fr", ".001").otherwise("")))),
        kill_chain_phases=F.transform(
            F.when(lang == "en", _strings(*map(F.lit, PHASES["en"]))).when(lang == "fr", _strings(F.lit(PHASES["fr"][0])))
            .when(lang == "de", _strings(F.lit(PHASES["de"][0]))).otherwise(_strings()),
            lambda p: F.struct(p.alias("phase_name"))),
        x_mitre_platforms=_strings("source", "lang"), x_mitre_detection=F.col("text"),
        x_mitre_is_subtechnique=F.when(lang == "fr", True), x_mitre_data_sources=F.when(lang == "en", _strings("source")),
    ))
    suppliers = load(spark, folder, "supplier").select(_line(
        type=F.lit(fixed.GROUP_TYPE), id=F.concat(F.lit("g-"), "s_suppkey"), name=F.col("s_name"),
        aliases=_strings("s_name", F.concat(F.lit("N"), "s_nationkey")), description=F.col("s_name"),
    ))
    orders = load(spark, folder, "orders").select(_line(
        type=F.lit(fixed.RELATIONSHIP_TYPE), source_ref=F.concat(F.lit("C"), "o_custkey"),
        target_ref=F.concat(F.lit("O"), "o_orderkey"), relationship_type=F.col("o_orderstatus"),
    ))
    return nations.unionByName(techniques).unionByName(suppliers).unionByName(orders)


def _objects(spark, folder) -> DataFrame:
    return bundle.explode_objects(bundle.parse_bundles(bundle_lines(spark, folder)))


def s1_read_bundles(spark, folder):
    """Bundles written as text files, read back, counted by object type."""
    path = f"{scratch_folder(spark)}/bundles"
    bundle_lines(spark, folder).write.text(path)
    objects = bundle.explode_objects(bundle.read_bundles(spark, path, one_per_line=True))
    return objects.groupBy(F.col("o.type").alias("type")).agg(F.count("*").alias("n"))


def s2a_tactics(spark, folder):
    return bundle.tactics(_objects(spark, folder))


def s2b_techniques(spark, folder):
    return bundle.techniques(_objects(spark, folder))


def s2c_groups(spark, folder):
    return bundle.groups(_objects(spark, folder))


def s2d_relationships(spark, folder):
    return bundle.relationships(_objects(spark, folder))


def labelled_techniques(spark, folder) -> DataFrame:
    """Processed techniques with their primary label."""
    return labels.with_primary_label(_processed(spark, folder))


def _processed(spark, folder):
    return bundle.preprocess_techniques(s2b_techniques(spark, folder))


def p6_p7_f2_processed_techniques(spark, folder):
    return _processed(spark, folder).select("id", "clean_description", "clean_detection", "text_for_nlp")


def p8_f5_primary_label(spark, folder):
    return labels.with_primary_label(_processed(spark, folder)).select("id", "tactics", "primary_tactic")


def p8_f5_primary_label_strict(spark, folder):
    rows = _processed(spark, folder)
    first_two = F.array_join(F.reverse(F.split("tactics", ", ")), ", ")       # last entry first
    both = rows.unionByName(rows.withColumn("tactics", first_two).withColumn("id", F.concat("id", F.lit("r"))))
    return labels.with_primary_label(both, "strict").select("id", "tactics", "primary_tactic")


def p9_head(spark, folder):
    return _processed(spark, folder).select("id", "name", "tactics", "platforms").orderBy("id").limit(5)


def s4_s5_csv_tables(spark, folder):
    """Techniques written as CSV and read back; empty text comes back as null and is filled again."""
    path = f"{scratch_folder(spark)}/techniques"
    sinks.write_csv(s2b_techniques(spark, folder), path)
    return tables.read_csv(spark, path, schemas.TECHNIQUES).fillna("")


def s5_all_tables(spark, folder):
    """The four tables of the bundles written as CSV and read back: table, first and second key column of each row."""
    path = f"{scratch_folder(spark)}/tables"
    made = bundle.bundle_tables(cut(bundle.parse_bundles(bundle_lines(spark, folder))))
    sinks.write_tables(made, path)
    keys = {"tactics": ("short_name", "name"), "techniques": ("stix_id", "name"), "groups": ("stix_id", "name"),
            "relationships": ("source_ref", "target_ref")}
    read = [
        tables.read_csv(spark, f"{path}/{name}", made[name].schema).select(
            F.lit(name).alias("table_name"), F.col(first).alias("first_key"), F.col(second).alias("second_key"))
        for name, (first, second) in keys.items()
    ]
    return reduce(DataFrame.unionByName, read)


def s6_json_results(spark, folder):
    """Ranked groups written as JSON lines and read back."""
    path = f"{scratch_folder(spark)}/groups"
    sinks.write_json(s2c_groups(spark, folder), path)
    return spark.read.schema(schemas.GROUPS).json(path)


def p2_p4_event_fields(spark, folder):
    """A field of the JSON text of each event, then per type and day."""
    events = load(spark, folder, "events")
    field = F.coalesce(F.from_json("props", "k long")["k"], F.lit(0))
    return events.select("event_type", F.to_date("ts").alias("day"), field.alias("k")).groupBy("event_type", "day").agg(
        F.count("*").alias("n"), F.sum("k").alias("total")
    )


NUMBER = "(doc_id + 1000)"
TECHNIQUES_SQL = f"""
SELECT CASE lang WHEN 'es' THEN '' WHEN 'de' THEN 'TA' || {NUMBER} WHEN 'fr' THEN 'T' || {NUMBER} || '.001'
    ELSE 'T' || {NUMBER} END AS id,
  'doc-' || doc_id AS stix_id, source AS name,
  '(Citation: ' || source || ') https://' || source || '.example.org [[' || lang || ']] ' || text AS description,
  CASE lang WHEN 'en' THEN 'execution, initial-access' WHEN 'fr' THEN 'command-and-control' WHEN 'de' THEN 'unknown-phase'
    ELSE '' END AS tactics,
  source || ', ' || lang AS platforms, lang = 'fr' AS is_subtechnique, text AS detection,
  CASE lang WHEN 'en' THEN source ELSE '' END AS data_sources
FROM documents"""
PROCESSED_SQL = f"""
(SELECT *, {sql_clean('description')} AS clean_description, {sql_clean('detection')} AS clean_detection,
   name || '. ' || {sql_clean('description')} AS text_for_nlp
 FROM ({TECHNIQUES_SQL}) WHERE regexp_matches(id, '^T[0-9]+'))"""
LABELS_SQL = "(VALUES " + ", ".join(f"({q(x)})" for x in fixed.LABELS) + ") AS l(label)"

QUERIES = {
    "s1_read_bundles": s1_read_bundles,
    "s2a_tactics": s2a_tactics,
    "s2b_techniques": s2b_techniques,
    "s2c_groups": s2c_groups,
    "s2d_relationships": s2d_relationships,
    "p2_p4_event_fields": p2_p4_event_fields,
    "p6_p7_f2_processed_techniques": p6_p7_f2_processed_techniques,
    "p8_f3_f5_primary_label": p8_f5_primary_label,
    "p8_f3_f5_primary_label_strict": p8_f5_primary_label_strict,
    "p9_head": p9_head,
    "s4_s5_csv_tables": s4_s5_csv_tables,
    "s5_all_tables": s5_all_tables,
    "s6_json_results": s6_json_results,
}

ORACLES = {
    "s1_read_bundles": f"""
SELECT {q(fixed.TACTIC_TYPE)} AS type, count(*) AS n FROM nation UNION ALL SELECT {q(fixed.TECHNIQUE_TYPE)}, count(*) FROM documents
UNION ALL SELECT {q(fixed.GROUP_TYPE)}, count(*) FROM supplier
UNION ALL SELECT {q(fixed.RELATIONSHIP_TYPE)}, count(*) FROM orders""",
    "s2a_tactics": """
SELECT CASE WHEN n_regionkey = 0 THEN '' ELSE 'TA' || n_nationkey END AS id, n_name AS name,
  'Region ' || n_regionkey AS description, lower(n_name) AS short_name FROM nation""",
    "s2b_techniques": TECHNIQUES_SQL,
    "s2c_groups": "SELECT 'g-' || s_suppkey AS stix_id, s_name AS name, s_name || ', N' || s_nationkey AS aliases, "
                  "s_name AS description FROM supplier",
    "s2d_relationships": "SELECT 'C' || o_custkey AS source_ref, 'O' || o_orderkey AS target_ref, "
                         "o_orderstatus AS relationship_type FROM orders",
    "p2_p4_event_fields": "SELECT event_type, ts::DATE AS day, count(*) AS n, "
                          "sum(coalesce((props::JSON ->> '$.k')::BIGINT, 0))::BIGINT AS total FROM events GROUP BY ALL",
    "p6_p7_f2_processed_techniques": f"SELECT id, clean_description, clean_detection, text_for_nlp FROM {PROCESSED_SQL}",
    "p8_f3_f5_primary_label": f"""
SELECT id, tactics, label AS primary_tactic FROM {PROCESSED_SQL} JOIN {LABELS_SQL}
  ON lower(replace(label, ' ', '-')) = lower(trim(split_part(tactics, ',', 1)))""",
    "p8_f3_f5_primary_label_strict": f"""
SELECT id, tactics, label AS primary_tactic FROM (
  SELECT id, tactics FROM {PROCESSED_SQL} UNION ALL
  SELECT id || 'r', array_to_string(list_reverse(string_split(tactics, ', ')), ', ') FROM {PROCESSED_SQL})
JOIN {LABELS_SQL} ON label = upper(substr(trim(split_part(tactics, ',', 1)), 1, 1)) || lower(substr(trim(split_part(tactics, ',', 1)), 2))""",
    "p9_head": f"SELECT id, name, tactics, platforms FROM {PROCESSED_SQL} ORDER BY id LIMIT 5",
    "s4_s5_csv_tables": TECHNIQUES_SQL,
    "s5_all_tables": """
SELECT 'tactics' AS table_name, lower(n_name) AS first_key, n_name AS second_key FROM nation UNION ALL
SELECT 'techniques', 'doc-' || doc_id, source FROM documents UNION ALL
SELECT 'groups', 'g-' || s_suppkey, s_name FROM supplier UNION ALL
SELECT 'relationships', 'C' || o_custkey, 'O' || o_orderkey FROM orders""",
    "s6_json_results": "SELECT 'g-' || s_suppkey AS stix_id, s_name AS name, s_name || ', N' || s_nationkey AS aliases, "
                       "s_name AS description FROM supplier",
}
