"""Bundle parsing, table round trips, graph export."""

import json

from inkgraph import schemas
from inkgraph.operators import graph
from inkgraph.sources import bundle, sinks, tables

OBJECTS = [
    {"type": "x-mitre-tactic", "name": "Execution", "description": "d", "x_mitre_shortname": "execution",
     "external_references": [{"external_id": "TA0002", "source_name": "s"}]},
    {"type": "x-mitre-tactic", "name": "Empty", "external_references": []},
    {"type": "attack-pattern", "id": "ap-1", "name": "Phish", "description": "See (Citation: A) [[x]] " + "y" * 600,
     "external_references": [{"external_id": "T1566"}, {"external_id": "other"}],
     "kill_chain_phases": [{"phase_name": "initial-access"}, {"kill_chain_name": "k"}],
     "x_mitre_platforms": ["Linux", "macOS"], "x_mitre_detection": "w" * 400, "x_mitre_data_sources": ["a", "b"]},
    {"type": "attack-pattern", "id": "ap-2", "name": "Sub", "x_mitre_is_subtechnique": True, "description": None,
     "external_references": [{"external_id": "T1566.001"}]},
    {"type": "attack-pattern", "id": "ap-3", "name": "NoRef", "external_references": []},
    {"type": "attack-pattern", "id": "ap-4", "name": "TacticId", "external_references": [{"external_id": "TA0001"}]},
    {"type": "intrusion-set", "id": "g-1", "name": "G", "aliases": ["G", "H"], "description": "z"},
    {"type": "relationship", "source_ref": "g-1", "target_ref": "ap-1", "relationship_type": "uses"},
    {"type": "something-else", "name": "ignored"},
    {"name": "no type"},
]


def bundle_file(tmp_path):
    path = tmp_path / "bundle.json"
    path.write_text(json.dumps({"type": "bundle", "objects": OBJECTS}, indent=1))
    return str(path)


def test_tables_of_a_bundle(spark, tmp_path):
    found = bundle.bundle_tables(bundle.read_bundles(spark, bundle_file(tmp_path)))
    assert [tuple(r) for r in found["tactics"].collect()] == [
        ("TA0002", "Execution", "d", "execution"), ("", "Empty", "", "")]
    rows = {r["stix_id"]: r for r in found["techniques"].collect()}
    assert list(rows) == ["ap-1", "ap-2", "ap-3", "ap-4"]
    one = rows["ap-1"]
    assert (one["id"], one["tactics"], one["platforms"], one["data_sources"], one["is_subtechnique"]) == (
        "T1566", "initial-access, ", "Linux, macOS", "a, b", False)
    whole = {o.get("id"): o for o in OBJECTS}["ap-1"]
    assert (one["description"], one["detection"]) == (whole["description"], whole["x_mitre_detection"])
    short = bundle.techniques(bundle.explode_objects(bundle.read_bundles(spark, bundle_file(tmp_path))), 500, 300)
    first = short.filter("stix_id = 'ap-1'").first()
    assert len(first["description"]) == 500 and len(first["detection"]) == 300
    assert rows["ap-2"]["is_subtechnique"] is True and rows["ap-2"]["description"] == "" and rows["ap-3"]["id"] == ""
    assert [tuple(r) for r in found["groups"].collect()] == [("g-1", "G", "G, H", "z")]
    assert [tuple(r) for r in found["relationships"].collect()] == [("g-1", "ap-1", "uses")]
    assert found["techniques"].schema.simpleString() == schemas.TECHNIQUES.simpleString()


def test_preprocessing_filters_ids_and_cleans(spark, tmp_path):
    techniques = bundle.bundle_tables(bundle.read_bundles(spark, bundle_file(tmp_path)))["techniques"]
    rows = {r["id"]: r for r in bundle.preprocess_techniques(techniques).collect()}
    assert set(rows) == {"T1566", "T1566.001"}
    assert rows["T1566"]["text_for_nlp"].startswith("Phish. See x yyy") and rows["T1566.001"]["text_for_nlp"] == "Sub. "


def test_objects_one_per_line(spark, tmp_path):
    path = tmp_path / "objects.json"
    path.write_text("\n".join(map(json.dumps, OBJECTS)))
    assert bundle.groups(bundle.read_objects(spark, str(path))).count() == 1


def test_csv_keeps_text(spark, tmp_path):
    rows = [("1", "a, \"b\"", " padded \n line "), ("2", "", None)]
    sinks.write_tables({"reports": spark.createDataFrame(rows, schemas.REPORTS)}, str(tmp_path))
    back = tables.read_csv(spark, str(tmp_path / "reports"), schemas.REPORTS).orderBy("id").collect()
    assert tuple(back[0]) == rows[0] and tuple(back[1]) == ("2", None, None)


def test_json_and_parquet_round_trip(spark, tmp_path):
    reports = tables.sample_reports(spark)
    sinks.write_json(reports, str(tmp_path / "j"))
    sinks.write_parquet(reports, str(tmp_path / "p"))
    assert spark.read.schema(schemas.REPORTS).json(str(tmp_path / "j")).exceptAll(reports).count() == 0
    assert spark.read.parquet(str(tmp_path / "p")).count() == 5


def test_graph_export(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", 0.12345), ("b", "c", None)], "src string, dst string, weight double")
    nodes = spark.createDataFrame([("a", None, None)], schemas.NODES)
    g = graph.build_graph(nodes, edges)
    sinks.write_graph(g.nodes, g.edges, str(tmp_path / "g"))
    links = spark.read.json(str(tmp_path / "g" / "links")).orderBy("source").collect()
    assert [(r["source"], r["target"], r["weight"]) for r in links] == [("a", "b", .123), ("b", "c", .5)]
    assert {(r["id"], r["description"], r["type"]) for r in spark.read.json(str(tmp_path / "g" / "nodes")).collect()} == {
        (x, "", "tactic") for x in "abc"}
    assert tables.profile_names(spark).count() == 4
