"""No step makes more rows than its input and result account for, and none gathers what grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import bridge


def most_rows(df) -> int:
    """Runs a frame; the largest number of rows that any step of it put out."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    most, todo = 0, [execution.executedPlan()]
    while todo:
        node = todo.pop()
        found = node.metrics().get("numOutputRows")
        most = max(most, found.get().value() if found.isDefined() else 0)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _edges(spark, n: int) -> dict:
    """``n`` pairs, one claim about all catalysts and all reactions, one procedure that names all reactions."""
    row = lambda source, target: spark.range(n).select(F.expr(source).alias("source"), F.expr(target).alias("target"))
    cat, rxn = "concat('cat:', id)", "concat('rxn:', id)"
    pair = spark.range(n).select(F.array("id").alias("ord"), F.lit("paper:1").alias("paper_uid"), F.expr(cat).alias("source"), F.expr(rxn).alias("target"))
    return {
        "TESTED_IN": pair, "APPLIES_TO_CATALYST": row("'claim:1'", cat), "ABOUT_REACTION": row("'claim:1'", rxn), "HAS_EVIDENCE": row("'claim:1'", "'evidence:1'").distinct(),
        "APPLIES_TO": row("'proc:1'", cat), "SPECIFIC_TO": row("'proc:1'", rxn), "HAS_STEP": row("'proc:1'", "'step:1'").distinct(),
    }


def test_claims_are_not_paired_with_all_reactions_of_their_catalysts(spark):
    n = 300
    found = bridge.contexts(_edges(spark, n), {"claim"})
    assert found.groupBy("member").count().rdd.map(tuple).collectAsMap() == {"claim:1": n, "evidence:1": n}
    assert most_rows(found) <= 2 * n


def test_reactions_of_a_procedure_are_no_list(spark):
    n = 50
    edges = _edges(spark, n) | {"SPECIFIC_TO": _edges(spark, n)["SPECIFIC_TO"].where("target <> 'rxn:7'")}
    found = bridge.contexts(edges, {"procedure"})
    assert found.groupBy("member").count().rdd.map(tuple).collectAsMap() == {"proc:1": n - 1, "step:1": n - 1}
    assert "collect_set" not in plan_of(found)


def test_pairs_of_a_document_do_not_travel_again(spark):
    from tesserae.plans.queries import TAG_PAIRS, cooccur, order_contexts

    sf = "/root/testdata/sf0.001"
    near = order_contexts(spark, sf)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    found = bridge.pair_lists(near, TAG_PAIRS, witnesses=False)
    assert exchanges(found) <= exchanges(near) + 1  # that of the edges' sums alone
    assert exchanges(cooccur(spark, sf)) <= exchanges(near) + 1


def test_witnesses_are_counted_without_a_list(spark):
    tags = spark.sql("select array(id) as ctx, concat('p', id % 7) as paper_uid, 2000 + id % 7 as year, inline(array(named_struct('tag', 'x', 'type', 'a'), named_struct('tag', 'y', 'type', 'b'))) from range(50)")
    found = bridge.pair_up(tags, [("a", "b", "LIKELY_USES")])
    assert [tuple(r) for r in found.collect()] == [("x", "y", "LIKELY_USES", 50, [f"p{k}" for k in range(7)], 2000, 2006, 7)]
    counted = found.select("source", "target", "co_occurrence_count", "witness_paper_count")
    assert "collect_" not in plan_of(counted).partition("Aggregate")[2].partition("Aggregate")[0]


def test_likely_uses_plans_its_own_branches_alone(spark):
    from tesserae.plans.queries import graph_likely_uses

    plan = graph_likely_uses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "task5" not in plan and "task3" not in plan  # neither measurements nor procedures are read
    assert plan.count("Scan parquet") <= 9


def test_likely_uses_leaves_the_other_layers_unplanned(spark, monkeypatch):
    from tesserae.operators import canonical, post
    from tesserae.plans.queries import graph_likely_uses

    made = []
    for module, name in ((canonical, "catalyst_names"), (canonical, "families_of"), (bridge, "template_similarity"), (bridge, "build_lifted"), (post, "valid_edges")):
        monkeypatch.setattr(module, name, lambda *a, name=name, real=getattr(module, name), **k: made.append(name) or real(*a, **k))
    assert graph_likely_uses(spark, "/root/testdata/sf0.001").count() > 0 and made == []


def test_first_occurrences_are_found_without_a_sort_of_all(spark):
    from tesserae.operators import ontology
    from tesserae.plans.queries import ontology_terms

    rows = [([3, 1], " A"), ([2, 9], "a"), ([2, 4], "A "), ([2, 4, 0], "a"), (None, "b"), ([1], "B"), ([None, 1], "C"), ([0], "c"), ([], "D"), ([7], "d"), ([-1], "e"), ([-1, 0], "E")]
    nodes = spark.createDataFrame([(f"u{k}", "p", o, x) for k, (o, x) in enumerate(rows)], "uid string, paper_uid string, ord array<bigint>, x string")
    terms, _ = ontology.build_ontology_layer({"T": nodes}, [("T", "x", "x", "HAS")])
    want = {"a": ([2, 4], "A"), "b": (None, "b"), "c": ([None, 1], "C"), "d": ([], "D"), "e": ([-1], "e")}
    assert {r["canonical_name"]: (r["ord"], r["display_name"]) for r in terms.collect()} == {k: (None if o is None else [0, *o, 0], x) for k, (o, x) in want.items()}
    plan = ontology_terms(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan  # a list's minimum alone would sort every occurrence


def test_a_pair_is_drawn_for_again_only_after_a_link(spark, monkeypatch):
    from tesserae.operators import negatives

    sizes, real = [], negatives.staged
    monkeypatch.setattr(negatives, "staged", lambda df, name: sizes.append((name, real(df, name))) or sizes[-1][1])
    pairs = spark.range(2000).selectExpr("id as source", "id % 500 as target")
    assert negatives.hard_negatives(pairs).count() == 2000
    drawn = sum(f.count() for name, f in sizes if name == "draws")
    assert 2000 < drawn < 2100


def test_alike_sequences_are_sought_through_once(spark, monkeypatch):
    from tesserae.operators import sequences

    sizes, real = [], sequences.staged
    monkeypatch.setattr(sequences, "staged", lambda df, name: sizes.append(real(df, name)) or sizes[-1])
    rows = [(i, ["a", "b"]) for i in range(500)] + [(0, ["a", "c"]), (None, ["a"]), (None, ["b", "a"]), (7, None)]
    patterns, members = sequences.frequent_patterns(spark.createDataFrame(rows, "id long, items array<string>"), 2, 3)
    assert {tuple(r["pattern"]): r["support"] for r in patterns.collect()} == {("a",): 501, ("b",): 501, ("a", "b"): 500}
    got = {(r["id"], tuple(r["pattern"])) for r in members.collect()}
    assert got == {(i, p) for i in range(500) for p in (("a",), ("b",), ("a", "b"))} | {(None, ("a",)), (None, ("b",))} and members.count() == len(got)
    assert max(f.count() for f in sizes) < 20


def test_points_of_few_alike_are_shuffled_once(spark, monkeypatch):
    from tesserae.operators import compare

    rows = "select concat('u', id) as uid, if(id < 40, 0, id % 9) as part, id % 5 as supplier, id % 11 + 0.0D as price, cast(id % 13 as double) as q, cast(id % 17 as double) as d, id % 3 as paper from range(160) union all select 'n', null, 1, 1.0D, 1.0D, 1.0D, 9 union all select 'm', 1, 1, 1.0D, double('nan'), 1.0D, 9"
    points, bands = spark.sql(rows), {"q": 2.0, "d": 3.0}
    both = lambda: (sorted(map(tuple, compare.comparable(points, "uid", ["part"], bands, "paper").collect())), sorted(map(tuple, compare.outcomes(points, "supplier", "price", ["part"], bands).collect())))
    near = compare.comparable(points, "uid", ["part"], bands, "paper")
    assert most_rows(near.where("source < target")) < 30 * 160
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    few = both()
    monkeypatch.setattr(compare, "CROWD", 30)  # part 0 alone takes bins
    some = both()
    monkeypatch.setattr(compare, "CROWD", 0)  # all take bins
    assert few == some == both() and len(few[0]) > 50


def test_bundles_are_counted_without_their_lists(spark):
    from tesserae.plans.queries import paper_bundles

    plan = plan_of(paper_bundles(spark, "/root/testdata/sf0.001"))
    assert "collect_list" not in plan and "Sort [" not in plan.replace("Sort [l_", "")


def test_bundles_of_the_query_hold_their_lists_in_order(spark, monkeypatch):
    from tesserae.plans.queries import paper_bundles
    from tesserae.sources import io

    kept, real = {}, io.staged
    monkeypatch.setattr(io, "staged", lambda df, name: kept.setdefault(name, real(df, name)))
    sizes = {r["doi"]: (r["n_nodes"], r["n_edges"]) for r in paper_bundles(spark, "/root/testdata/sf0.001").collect()}
    rows = kept["bundles"].orderBy(F.monotonically_increasing_id()).collect()
    assert {r["doi"]: (len(r["nodes"]), len(r["edges"] or [])) for r in rows} == sizes and len(rows) == len(sizes) > 0
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert sum(e["edge_type"] == "HAS_ITEM" and e["source"] == r["paper_uid"] for r in rows for e in r["edges"] or []) == items
    place = lambda r: (r["year"], r["doi"], r["paper_uid"])
    parts = [[place(r) for r in part] for part in kept["bundles"].rdd.glom().collect() if part]
    assert all(part == sorted(part) for part in parts) and sorted(map(place, rows)) == [p for part in sorted(parts) for p in part]


def test_the_queue_on_disk_is_small_and_whole(spark, monkeypatch):
    from pathlib import Path

    from tesserae.plans.models import normalized_queue
    from tesserae.sources import io

    read, real = [], io.read_json_array
    monkeypatch.setattr(io, "read_json_array", lambda s, path, schema: read.append((path, real(s, path, schema))) or read[-1][1])
    monkeypatch.setattr(io, "staged", None)  # one branch reads the documents
    told = normalized_queue(spark, "/root/testdata/sf0.001")
    path, queue = read[0]
    pairs = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_partkey").distinct().count()
    assert queue.count() == told.select("uid").distinct().count() == pairs
    assert queue.where("name_reported is null or aliases is null or series_name is null or size(labels_material_platform) <> 1").count() == 0
    size = sum(f.stat().st_size for f in Path(path.removeprefix("file:")).glob("part-*"))
    assert size < 40 * pairs  # 230 bytes a record where the fields' names are written out


def test_a_queue_is_cut_into_files_that_tasks_can_share(spark, tmp_path):
    from tesserae.sources import io

    rows = spark.range(600_000).coalesce(1).selectExpr("cast(id as string) as uid", "array('\\u00e9', '') as aliases")
    io.write_queue(rows, str(tmp_path / "queue.jsonl"))
    found = io.read_json_array(spark, str(tmp_path / "queue.jsonl"), "uid string, aliases array<string>")
    assert found.count() == found.select("uid").distinct().count() == 600_000 and found.select("aliases").distinct().collect() == rows.select("aliases").distinct().collect()
    assert len(list((tmp_path / "queue.jsonl").glob("part-*"))) == 3
