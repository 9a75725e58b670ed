"""Explicit schemas; nothing in this package infers one."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRING = T.StringType()
STRINGS = T.ArrayType(STRING)

# One typed object of a bundle.
OBJECT = _struct(
    type=STRING,
    id=STRING,
    name=STRING,
    description=STRING,
    external_references=T.ArrayType(_struct(external_id=STRING)),
    kill_chain_phases=T.ArrayType(_struct(phase_name=STRING)),
    x_mitre_shortname=STRING,
    x_mitre_platforms=STRINGS,
    x_mitre_data_sources=STRINGS,
    x_mitre_is_subtechnique=T.BooleanType(),
    x_mitre_detection=STRING,
    aliases=STRINGS,
    source_ref=STRING,
    target_ref=STRING,
    relationship_type=STRING,
)
BUNDLE = _struct(objects=T.ArrayType(OBJECT))

TACTICS = _struct(id=STRING, name=STRING, description=STRING, short_name=STRING)
TECHNIQUES = _struct(
    id=STRING, stix_id=STRING, name=STRING, description=STRING, tactics=STRING, platforms=STRING,
    is_subtechnique=T.BooleanType(), detection=STRING, data_sources=STRING,
)
PROCESSED_TECHNIQUES = T.StructType(
    TECHNIQUES.fields
    + _struct(clean_description=STRING, clean_detection=STRING, text_for_nlp=STRING).fields
)
GROUPS = _struct(stix_id=STRING, name=STRING, aliases=STRING, description=STRING)
RELATIONSHIPS = _struct(source_ref=STRING, target_ref=STRING, relationship_type=STRING)
REPORTS = _struct(id=STRING, title=STRING, text=STRING)

# Values of an ordered label dimension and of its keyword table.
LABELS = _struct(label=STRING, label_ord=T.IntegerType())
KEYWORDS = _struct(label=STRING, label_ord=T.IntegerType(), keyword=STRING)

# Ranked predictions: array<struct<label, score>>.
RANKED = T.ArrayType(_struct(label=STRING, score=T.DoubleType()))

NODES = _struct(id=STRING, description=STRING, type=STRING)
EDGES = _struct(src=STRING, dst=STRING, weight=T.DoubleType(), probability=T.DoubleType())
MEMBERS = _struct(**{"class": STRING, "member_id": STRING, "member_name": STRING})
SCENARIOS = _struct(name=STRING, start=STRING, end=STRING, description=STRING)
PROFILE_NAMES = _struct(cluster=T.IntegerType(), name=STRING)
