"""The two-document fixture, built end to end."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tesserae.operators import bridge, instance, post, readmodel
from tesserae.plans.build import build_graph, build_likely, merge_graphs
from tesserae.sources import io

FX1 = [
    json.loads(line)
    for line in (
        '{"DOI":"10.1/A b","title":"a","time":[2020,3],"task1":{"reaction_catalog":[{"reaction_id":"R1","reaction_family":["OER"]}]},"task2":{"catalyst_catalog":[{"catalyst_id":"C1","name_reported":"5 wt% LaCoO3","tested_reaction_ids":["R1","R1"],"labels_material_platform":["Perovskite"],"labels_active_site_form":["oxygen vacancy"]}]},"task3":{"procedure_catalog":[{"procedure_id":"P1","catalyst_ids":["C1"],"reaction_ids":[],"steps":[{"step_no":1,"step_type":"calcination"},{"step_no":2,"step_type":"reduction"}]}]},"task4":{},"task5":{"performance_records":[{"dataset_id":"PR1","reaction_id":"R1","operating_points":[{"point_id":"OP1","metrics_by_catalyst":[{"catalyst_id":"C1","metrics":[{"property_name":"overpotential"}]}]}]}]}}',
        '{"DOI":"10.1/B","title":"b","time":[],"task1":{"reaction_catalog":[{"reaction_id":"R1","reaction_family":["OER"]}]},"task2":{"catalyst_catalog":[{"catalyst_id":"C1","name_reported":"LaCoO3","tested_reaction_ids":["R1","R9"],"labels_material_platform":["perovskite "]}]},"task3":{},"task4":{},"task5":{}}',
    )
]


@pytest.fixture(scope="module")
def graph(spark):
    papers = io.papers_from_rows(spark, FX1).persist()
    g = build_graph(papers)
    g.nodes, g.edges = g.nodes.persist(), g.edges.persist()
    nodes = [r.asDict(recursive=True) for r in g.nodes.collect()]
    edges = [r.asDict(recursive=True) for r in g.edges.collect()]
    return papers, g, nodes, edges


def test_node_counts(graph):
    counts: dict[str, int] = {}
    for n in graph[2]:
        counts[n["node_type"]] = counts.get(n["node_type"], 0) + 1
    assert counts == {
        "Paper": 2, "Reaction": 2, "Catalyst": 2, "Procedure": 1, "ProcedureStep": 2, "PerformanceDataset": 1, "OperatingPoint": 1,
        "Metric": 1, "OntologyTerm": 6, "ReactionTemplate": 1, "CatalystFamily": 1,
    }


def test_uids_and_terms(graph):
    by = {n["uid"]: n for n in graph[2]}
    assert "metric:10.1_ab:PR1:OP1:C1:B1:M1" in by
    assert by["onto:reaction_family:oer"]["display_name"] == "OER"
    assert by["onto:material_platform:perovskite"]["display_name"] == "Perovskite"
    assert {u for u in by if u.startswith("onto:")} == {
        "onto:reaction_family:oer", "onto:material_platform:perovskite", "onto:active_site_form:oxygen_vacancy",
        "onto:step_type:calcination", "onto:step_type:reduction", "onto:property_name:overpotential",
    }


def test_clusters(graph):
    by = {n["node_type"]: n for n in graph[2]}
    t, f = by["ReactionTemplate"], by["CatalystFamily"]
    assert (t["uid"], t["merge_key"], t["template_name"], t["family_label"], t["instance_count"]) == ("rxn_template:RT1", "rule:unknown||unknown||oer||T:unknown", "unknown", "OER", 2)
    assert (f["uid"], f["canonical_name"], f["instance_count"]) == ("cat_family:CF1", "LaCoO3", 2)
    assert f["dominant_material_platform"] == ["Perovskite", "perovskite "] and f["dominant_active_site_form"] == ["oxygen vacancy"]
    assert f["member_uids"] == ["catalyst:10.1_ab:C1", "catalyst:10.1_b:C1"]


def test_bridge_edges(graph):
    edges = graph[3]
    uses = [e for e in edges if e["edge_type"] == "LIKELY_USES"]
    assert [(e["source"], e["target"], e["co_occurrence_count"], e["witness_paper_count"], e["first_year"], e["last_year"]) for e in uses] == [
        ("onto:reaction_family:oer", "onto:material_platform:perovskite", 3, 2, 2020, 2020)
    ]
    assert uses[0]["witness_papers"] == ["paper:10.1_ab", "paper:10.1_b"]
    linked = [e for e in edges if e["edge_type"] == "LIKELY_ASSOCIATED_WITH"]
    assert len(linked) == 9 and {(e["co_occurrence_count"], e["witness_paper_count"]) for e in linked} == {(2, 1)}
    lifted = [e for e in edges if e["edge_type"] == "TESTED_IN_TEMPLATE"]
    assert [(e["source"], e["target"], e["witness_count"], e["witness_paper_count"]) for e in lifted] == [("cat_family:CF1", "rxn_template:RT1", 3, 2)]


def test_final_edges(graph):
    edges = graph[3]
    assert len(edges) == 40 and len({e["edge_type"] for e in edges}) == 22
    assert not [e for e in edges if e["target"].endswith(":R9")]
    stats = graph[1].stats
    assert stats["summary"] == {"total_nodes": 20, "total_edges": 40, "unique_node_types": 11, "unique_edge_types": 22}
    assert stats["likely_edges"]["count"] == 10 and stats["co_studied_edges"] == {"count": 0, "avg_co_occurrence": 0}


def test_pruned_legs_equal_all_legs(graph, spark):
    papers, g, _, _ = graph
    layer = instance.build_instance_layer(papers)
    onto = g.by_type["OntologyTerm"]
    from tesserae.operators import ontology

    _, onto_edges = ontology.build_ontology_layer(layer.nodes)
    every = {"pair", "procedure", "characterization", "performance", "claim"}
    key = lambda df: sorted(map(str, df.select("source", "target", "edge_type", "co_occurrence_count").collect()))
    a = bridge.build_cooccurrence(layer.edge_tables, onto_edges, onto, layer.nodes["Paper"])
    b = bridge.build_cooccurrence(layer.edge_tables, onto_edges, onto, layer.nodes["Paper"], legs=every)
    assert key(a) == key(b)


def test_duplicate_uid_raises(spark):
    twice = json.loads(json.dumps(FX1[0]))
    twice["task1"]["reaction_catalog"] *= 2
    layer = instance.build_instance_layer(io.papers_from_rows(spark, [twice]))
    with pytest.raises(ValueError, match="reaction:10.1_ab:R1"):
        post.assert_unique_nodes(layer.nodes["Reaction"].select("uid"))


def test_polymorphic_catalyst_and_evidence(spark):
    paper = json.loads(json.dumps(FX1[0]))
    paper["task4"] = {"characterization_records": [{"record_id": "H1", "catalyst_id": ["C1", "C2"], "reaction_id": "R1"}, {"record_id": "H2", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C1", ""]}]}
    paper["task6"] = {"mechanistic_claims": [{"claim_id": "M1", "reaction_id": "R1", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C1", "C2"], "evidence_chain": [{"evidence_type": "x", "linked_characterization_record_ids": ["H1", ""], "linked_procedure_ids": ["P1"]}]}]}
    layer = instance.build_instance_layer(io.papers_from_rows(spark, [paper, FX1[1]]).persist())
    t = layer.edge_tables
    assert sorted(map(str, layer.edges.collect())) == sorted(map(str, layer.edges_by_union.collect()))
    got = lambda kind: sorted((r["source"], r["target"]) for r in t[kind].collect())
    assert got("APPLIES_TO_CATALYST") == sorted(
        [("char:10.1_ab:H1", "catalyst:10.1_ab:C1"), ("char:10.1_ab:H1", "catalyst:10.1_ab:C2")]
        + [("char:10.1_ab:H2", "catalyst:10.1_ab:C1")] * 2
        + [("claim:10.1_ab:M1", "catalyst:10.1_ab:C1"), ("claim:10.1_ab:M1", "catalyst:10.1_ab:C2")]
    )
    assert got("SUPPORTED_BY") == [("evidence:10.1_ab:M1:E1", "char:10.1_ab:H1"), ("evidence:10.1_ab:M1:E1", "procedure:10.1_ab:P1")]
    assert got("NEXT_STEP") == [("step:10.1_ab:P1:S1", "step:10.1_ab:P1:S2")]


def test_lists_are_measured_as_their_rows_count(graph, spark):
    """The fixture and a document with every section; no list is made more than once and no edge is."""
    rich = {
        "DOI": "10.1/C", "title": "c", "time": [2021], "task1": {"reaction_catalog": [{"reaction_id": "R1"}, {"reaction_id": "R2"}]}, "task2": {"catalyst_catalog": [{"catalyst_id": "C1"}, {"catalyst_id": "C2", "tested_reaction_ids": ["R1", ""]}]},
        "task3": {"procedure_catalog": [{"procedure_id": "P1", "catalyst_ids": ["C1", "C2"], "reaction_ids": ["R1", "", "R2"], "steps": [{"step_no": 1}, {"step_no": 2}, {"step_no": 3}]}, {"procedure_id": "P2"}]},
        "task4": {"characterization_records": [{"record_id": "H1", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C2", ""], "reaction_id": "R1"}, {"record_id": "H2", "catalyst_id": ""}]},
        "task5": {"performance_records": [{"dataset_id": "D1", "reaction_id": "", "operating_points": [{"point_id": "O1", "metrics_by_catalyst": [{"catalyst_id": "", "metrics": [{"property_name": "x"}, {"property_name": "y"}]}]}, {"point_id": "O2"}]}]},
        "task6": {"mechanistic_claims": [{"claim_id": "M1", "reaction_id": "R1", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C1", "C2"], "evidence_chain": [{"evidence_type": "e", "linked_procedure_ids": ["P1", ""], "linked_performance_dataset_ids": ["D1"]}]}, {"claim_id": "M2", "reaction_id": ""}]},
    }
    for papers in (graph[0], io.papers_from_rows(spark, [rich, rich, *FX1])):
        layer = instance.build_instance_layer(papers)
        edges = {(r["edge_type"], r["count"]) for r in layer.edges.groupBy("edge_type").count().collect()}
        assert {tuple(r) for r in instance.edge_counts(papers).collect()} == edges
        nodes = post.union_all(*[n.select("paper_uid", "node_type") for n in layer.nodes.values()])
        assert sorted(map(tuple, readmodel.with_place(instance.node_counts(papers)).collect())) == sorted(map(tuple, readmodel.type_counts_by_paper(nodes).collect()))


def test_counts_of_orders_make_no_edge_and_travel_by_document(spark):
    from tesserae.plans.models import types_by_paper
    from tesserae.plans.queries import instance_edges

    for query in (instance_edges, types_by_paper):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 3 and plan.count("reaction_id,") == 2  # one pass over the tables, without ids; the lists of reactions and of datasets are made once


def test_likely_edges_alone_are_those_of_the_graph(graph):
    row = lambda e: (e["source"], e["target"], e["edge_type"], e["co_occurrence_count"], e["witness_paper_count"])
    whole = sorted(row(e) for e in graph[3] if e["edge_type"] in readmodel.LIKELY)
    assert len(whole) == 10 and sorted(map(row, build_likely(graph[0]).collect())) == whole
    uses = [p for p in bridge.PAIRS if p[2] == "LIKELY_USES"]
    assert sorted(map(row, build_likely(graph[0], uses).collect())) == [e for e in whole if e[2] == "LIKELY_USES"]


def test_merge_equals_single(graph, spark):
    nodes, edges = graph[1].nodes, graph[1].edges
    half = nodes.where("uid < 'm'"), edges.where("source < 'm'")
    merged = merge_graphs([(nodes, edges), half])
    assert merged.nodes.count() == 20 and merged.edges.count() == 40


def test_read_models(graph):
    g = graph[1]
    bundles = {r["paper_uid"]: r for r in readmodel.paper_bundles(g.nodes, g.edges).collect()}
    sizes = {r["paper_uid"]: (r["year"], r["doi"], r["n_nodes"], r["n_edges"]) for r in readmodel.bundle_sizes(g.nodes, g.edges).collect()}
    assert sizes == {k: (r["year"], r["doi"], len(r["nodes"] or []), len(r["edges"] or [])) for k, r in bundles.items()}
    assert [n["uid"] for n in bundles["paper:10.1_b"]["nodes"]] == ["paper:10.1_b", "reaction:10.1_b:R1", "catalyst:10.1_b:C1"]
    assert {e["edge_type"] for e in bundles["paper:10.1_b"]["edges"]} == {"HAS_REACTION", "HAS_CATALYST", "TESTED_IN", "IN_FAMILY", "HAS_MATERIAL_PLATFORM"}
    assert readmodel.explorer_summary(g.nodes, g.edges).first().asDict() == {"total_edges": 40, "total_edge_types": 22, "total_co_occur": 10, "cross_paper_co_occur": 1, "total_nodes": 20}
    rows = readmodel.cooccurrence_rows(g.nodes, g.edges).collect()
    assert rows[0]["source_name"] == "OER" and rows[0]["target_onto_type"] == "material_platform"


def test_reader_keeps_order_and_bad_lines(spark, tmp_path):
    path = tmp_path / "papers.jsonl"
    path.write_text("\n".join([json.dumps(FX1[0]), "{broken", json.dumps(FX1[1])]) + "\n")
    rows = io.read_papers(spark, str(path)).orderBy("paper_ord").select("paper_ord", "DOI", F.col("_corrupt_record").alias("bad")).collect()
    assert [(r[0], r[1]) for r in rows] == [(0, "10.1/A b"), (1, None), (2, "10.1/B")] and rows[1]["bad"] == "{broken"
    with pytest.raises(ValueError, match="DOI"):
        io.check_required(io.read_papers(spark, str(path)))


def test_result_override_and_lines_out(spark, tmp_path):
    papers = io.papers_from_rows(spark, FX1)
    reactions = instance.build_instance_layer(papers).nodes["Reaction"]
    from tesserae.operators import canonical

    results = spark.createDataFrame([("reaction:10.1_ab:R1", " Oxygen  evolution ", ["OER", " oer2 "]), ("reaction:10.1_b:R1", "oxygen evolution", ["OER", ""])], "uid string, canonical_reaction_name string, canonical_reaction_aliases array<string>")
    nodes, edges = canonical.build_reaction_templates(reactions, results)
    row = nodes.collect()
    assert len(row) == 1 and row[0]["template_name"] == "Oxygen evolution" and row[0]["canonical_aliases"] == ["OER", "oer2"] and row[0]["merge_source"] == "llm"
    assert edges.count() == 2
    io.write_jsonl(nodes.withColumn("_private", F.lit(1)), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert "_private" not in text and json.loads(text.splitlines()[0])["instance_count"] == 2
