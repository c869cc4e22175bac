"""Comparisons, motifs, the search index, hierarchies and incremental layers, each against a plain version."""

from __future__ import annotations

import itertools
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tesserae.operators import bridge, canonical, compare, hierarchy, instance, motifs, ontology, searchindex, skew
from tesserae.plans import build
from tesserae.sources import io
from tesserae.streaming import layers


def test_units_come_to_one_scale(spark):
    given = {
        "25 °C": ("temperature", 298.15), "298.15K": ("temperature", 298.15), " 77 °F ": ("temperature", 298.15), "1.5 h": ("time", 5400.0), "90 min": ("time", 5400.0),
        "10 mA cm-2": ("current density", 100.0), "10 mA/cm2": ("current density", 100.0), "−0.2 V": ("potential", -0.2), "200 mV": ("potential", 0.2), "60 mL min-1": ("flow", 1e-6),
        "1e2 widgets": ("widgets", 100.0), "12": ("", 12.0), ".5 bar": ("pressure", 5e4), "about 3": None, "": None, None: None, "1 M": ("concentration", 1e3), "1 mM": ("concentration", 1.0),
    }
    df = spark.createDataFrame([(t,) for t in given], "t string").select("t", compare.measured("t").alias("m"))
    for r in df.collect():
        want = given[r["t"]]
        assert (r["m"] is None) == (want is None), r
        if want:
            assert r["m"]["kind"] == want[0] and r["m"]["number"] == pytest.approx(want[1], rel=1e-9), r


PAPER = {
    "DOI": "10.1/A", "time": [2020], "task1": {"reaction_catalog": [{"reaction_id": "R1"}]},
    "task2": {"catalyst_catalog": [{"catalyst_id": c, "name_reported": c, "tested_reaction_ids": ["R1"]} for c in ("C1", "C2")]}, "task3": {}, "task4": {}, "task6": {},
    "task5": {"performance_records": [{"dataset_id": "D", "reaction_id": "R1", "common_conditions": {"temperature": "25 °C", "pressure": "1 bar"}, "operating_points": [
        {"point_id": "O1", "point_conditions": {"temperature": "300 K"}, "metrics_by_catalyst": [{"catalyst_id": "C1", "metrics": [{"property_name": "FE ", "value": "80", "unit": "%"}]}]},
        {"point_id": "O2", "point_conditions": {}, "metrics_by_catalyst": [{"catalyst_id": "C2", "metrics": [{"property_name": "fe", "value": "0.5", "unit": ""}, {"property_name": "fe", "value": "high", "unit": ""}]}]}]}]},
}


def test_points_of_a_graph(spark):
    layer = instance.build_instance_layer(io.papers_from_rows(spark, [PAPER]))
    points = compare.metric_points(layer.nodes, layer.edge_tables, ["temperature", "pressure"])
    rows = sorted((r["subject"][-2:], r["property"], r["value"], r["value_kind"], r["temperature"], r["pressure"]) for r in points.where("value is not null").collect())
    assert rows == [("C1", "fe", 0.8, "share", 300.0, 1e5), ("C2", "fe", 0.5, "", 298.15, 1e5)] and points.count() == 3
    games = compare.outcomes(points, "subject", "value", ["reaction", "property"], {"temperature": 5.0, "pressure": 1.0}, by=["property"])
    edge = compare.outperforms(games).collect()
    assert [(r["source"][-2:], r["target"][-2:], r["property"], r["wins"]) for r in edge] == [("C1", "C2", "fe", 1)]


@pytest.mark.parametrize("heavy", [3, 1000])
def test_outcomes_equal_all_pairs(spark, heavy):
    rnd = random.Random(heavy)
    number = lambda: rnd.choice([0.0, 5.0, 10.0, 14.999, None, float("nan"), rnd.uniform(-30, 30)])
    rows = [(i, rnd.choice("pq"), rnd.choice(["s1", "s2", "s3", None]), rnd.choice([1.0, 2.0, 2.01, None]), number(), number()) for i in range(250)] + [(900 + i, "hot", f"s{i % 3}", float(i % 5), 1.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, part string, s string, v double, x double, y double")
    like = lambda a, b: a[1] == b[1] and all(a[k] is not None and b[k] is not None and abs(a[k] - b[k]) <= w for k, w in ((4, 5.0), (5, 10.0)))
    want = Counter()
    for a, b in itertools.permutations(rows, 2):
        if a[2] and b[2] and a[2] < b[2] and None not in (a[3], b[3]) and like(a, b):
            gap, least = a[3] - b[3], max(abs(a[3]), abs(b[3])) * 0.01
            want[a[2], b[2], 0 if gap > least else 1 if -gap > least else 2] += 1
    games = compare.outcomes(df, "s", "v", ["part"], {"x": 5.0, "y": 10.0}, margin=0.01, heavy=heavy)
    got = {(r["a"], r["b"], k): r[c] for r in games.collect() for k, c in enumerate(("wins", "losses", "ties")) if r[c]}
    assert got == dict(want)
    edges = compare.comparable(df, "id", ["part"], {"x": 5.0, "y": 10.0}, other="s", heavy=heavy)
    assert Counter((r["source"], r["target"]) for r in edges.collect()) == Counter((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[2] and b[2] and a[2] != b[2] and like(a, b))
    assert compare.outcomes(df.limit(0), "s", "v", ["part"], {"x": 5.0}).count() == 0


def test_strengths_equal_plain_iteration(spark):
    games = [("a", "b", 5, 1, 0), ("a", "c", 2, 2, 2), ("b", "c", 0, 3, 1), ("x", "y", 4, 0, 0)]
    got = {r["subject"]: r["strength"] for r in compare.strengths(spark.createDataFrame(games, "a string, b string, wins long, losses long, ties long"), rounds=5).collect()}
    now = dict.fromkeys("abcxy", 1.0)
    for _ in range(5):
        new = {}
        for s in now:
            met = [(o, w + t / 2, w + lo + t) for a, b, w, lo, t in games for me, o, w, lo in ((a, b, w, lo), (b, a, lo, w)) if me == s]
            new[s] = (sum(w for _, w, _ in met) + 1) / (sum(n / (now[s] + now[o]) for o, _, n in met) + 2 / (now[s] + 1))
        now = new
    assert got == pytest.approx(now)


def plain_join(relations):
    out = [{}]
    for cols, rows in relations.values():
        out = [m | r for m in out for r in (dict(zip(cols, x, strict=True)) for x in rows) if None not in r.values() and all(m.get(c, v) == v for c, v in r.items())]
    return {tuple(sorted(m.items())) for m in out}


@pytest.mark.parametrize("seed,heavy", [(1, 2), (2, 1000)])
def test_motifs_equal_plain_joins(spark, seed, heavy):
    rnd = random.Random(seed)
    rows = lambda n: [tuple(rnd.choice([0, 0, 1, 2, 3, 4, None]) for _ in range(n)) for _ in range(25)]
    given = {"r": (["a", "b"], rows(2)), "s": (["b", "c", "d"], rows(3)), "t": (["d", "e"], rows(2)), "u": (["c"], rows(1))}
    frames = {n: spark.createDataFrame(x, ", ".join(f"{c} int" for c in cols)) for n, (cols, x) in given.items()}
    want = plain_join(given)
    assert {tuple(sorted(r.asDict().items())) for r in motifs.matches(frames, heavy=heavy).collect()} == want
    for n, df in motifs.reduced(frames).items():
        cols = given[n][0]
        assert {tuple(r) for r in df.collect()} == {tuple(dict(m)[c] for c in cols) for m in want}
    counts = motifs.match_counts(frames, ["b", "d"])
    assert {(r["b"], r["d"]): r["n"] for r in counts.collect()} == Counter((dict(m)["b"], dict(m)["d"]) for m in want)


def test_motif_trees():
    with pytest.raises(ValueError):
        motifs.join_tree({"x": ["a", "b"], "y": ["b", "c"], "z": ["c", "a"]})
    with pytest.raises(ValueError):
        motifs.join_tree({"x": ["a", "b"], "y": ["c", "d"]})
    assert [t[0] for t in motifs.join_tree({"x": ["a", "b"], "y": ["b", "c"], "z": ["c", "d"]}, root="x")] == ["z", "y"]


def test_motifs_of_a_graph(spark):
    paper = json.loads(json.dumps(PAPER))
    paper["task3"] = {"procedure_catalog": [{"procedure_id": "P1", "catalyst_ids": ["C1"], "reaction_ids": ["R1"], "steps": []}]}
    paper["task4"] = {"characterization_records": [{"record_id": "H1", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C1"], "sample_state": "spent"}]}
    paper["task6"] = {"mechanistic_claims": [{"claim_id": "K1", "reaction_id": "R1", "catalyst_id": "C1", "applies_to_catalyst_ids": ["C1"], "claim_type": "x", "evidence_chain": []}]}
    layer = instance.build_instance_layer(io.papers_from_rows(spark, [paper]))
    _, tagged = ontology.build_ontology_layer(layer.nodes)
    found = {n: [tuple(str(v).rpartition(":")[2] for v in r) for r in motifs.matches(m).select(sorted(set().union(*[x.columns for x in m.values()]))).collect()] for n, m in motifs.graph_motifs(layer.edge_tables, tagged).items()}
    assert sorted(found["catalyst_reaction_point_property"]) == [("C1", "O1", "fe", "R1"), ("C2", "O2", "fe", "R1")]
    assert found["procedure_catalyst_reaction_state"] == [("C1", "P1", "R1", "spent")]
    assert found["catalyst_procedure_reaction_point_property"] == [("C1", "O1", "P1", "fe", "R1")]
    assert found["catalyst_characterization_claim_reaction_property"] == [("C1", "H1", "K1", "fe", "R1")]


def test_salted_join_keeps_all_rows(spark):
    left = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.createDataFrame([(1, "a"), (1, "b"), (450, "c"), (None, "d")], "k long, y string")
    assert sorted(map(tuple, skew.salted_join(left, right, ["k"], heavy=7).collect())) == sorted(map(tuple, left.join(right, "k").collect()))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rnd = random.Random(8)
    texts = [None, "", "ab", "ABC", "é€😀x İ", "the cat\nsat", *["".join(rnd.choice("abcdE ") for _ in range(rnd.randrange(40))) for _ in range(400)]]
    df = spark.createDataFrame([(i, t, "v") for i, t in enumerate(texts)], "id long, text string, block string").repartition(4)
    return df, searchindex.SearchIndex.build(df, "text", str(tmp_path_factory.mktemp("index") / "at"))


@pytest.mark.parametrize("text", ["abc", "dEa b", "€😀X", "i̇", "zzz", "ab", "", "t\ns", "abcdabcdabcd", "cat"])
def test_index_finds_what_a_scan_finds(index, text):
    df, ix = index
    got = ix.find(text)
    assert got.columns == df.columns
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in df.where(F.contains(F.lower("text"), F.lower(F.lit(text)))).collect())


def test_index_reads_less_than_a_scan(index):
    df, ix = index
    cost = ix.cost("€😀x")
    assert cost["verified"] == 1 and cost["postings"] <= 2 and cost["rows"] == df.count()
    assert ix.cost("zzz")["verified"] == 0 and ix.cost("ab")["verified"] == df.count()


def test_index_lists_by_blocks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(searchindex, "BLOCK", 4)
    monkeypatch.setattr(searchindex, "LISTED", 10)
    texts = ["abcab", "xabc", None, "", "abc", "bcd abc", "abc", "q"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3, 3 + len(texts))), pa.array(texts)], names=["p", "t"])
    got = {(g, b * 4 + p) for r in searchindex._postings(iter([batch])) for g, b, gaps in zip(*(c.to_pylist() for c in r.columns), strict=True) for p in itertools.accumulate(gaps)}
    assert got == {(int(g), 3 + i) for i, t in enumerate(texts) for g in searchindex.trigrams(t or "")}


def test_hierarchy_equals_plain_closure(spark):
    rnd = random.Random(4)
    edges = [(str(rnd.randrange(12)), str(rnd.randrange(12))) for _ in range(16)] + [("s", "s"), (None, "s"), ("s", None), ("a", "b"), ("a", "b")]
    near = {(c, p): 1 for c, p in edges if c and p}
    while True:
        more = {(c, a): d + 1 for (c, m), d in near.items() for (x, a) in list(near) if x == m and near[x, a] == 1}
        more = {k: min(d, near.get(k, 99)) for k, d in more.items() if d < near.get(k, 99)}
        if not more:
            break
        near |= more
    pairs = hierarchy.closure(spark.createDataFrame(edges, "child string, parent string"))
    assert {(r["term"], r["ancestor"]): r["distance"] for r in pairs.collect()} == near
    assert {(r["term"], r["length"]) for r in hierarchy.on_cycles(pairs).collect()} == {(c, d) for (c, a), d in near.items() if c == a}
    counts = spark.createDataFrame([("0", 2), ("1", 3), ("0", 5), ("z", 1)], "term string, n int")
    own = {"0": 7, "1": 3, "z": 1}
    want = {t: (own.get(t, 0), own.get(t, 0) + sum(n for c, n in own.items() if (c, t) in near and c != t)) for t in {*own, *(a for c, a in near if c in own)}}
    assert {r["term"]: (r["own"], r["total"]) for r in hierarchy.rollup(counts, pairs).collect()} == want


def test_intervals_tell_ancestors(spark):
    rnd = random.Random(6)
    parent = {f"n{i}": f"n{rnd.randrange(i)}" if i % 9 else "root" for i in range(1, 40)}
    got = {r["term"]: r for r in hierarchy.intervals(spark.createDataFrame(list(parent.items()), "child string, parent string")).collect()}
    up = lambda t: [parent[t], *up(parent[t])] if t in parent else []
    for a, b in itertools.permutations(got, 2):
        inside = got[a]["root"] == got[b]["root"] and got[b]["first"] < got[a]["first"] <= got[b]["last"]
        assert inside == (b in up(a))
    for bad in ([("a", "b"), ("a", "c")], [("a", "b"), ("b", "a")]):
        with pytest.raises(ValueError):
            hierarchy.intervals(spark.createDataFrame(bad, "child string, parent string"))


def _papers(spark, rows, first=0):
    return io.papers_from_rows(spark, rows).withColumn("paper_ord", F.col("paper_ord") + first)


def _paper(i):
    names = ["5 wt% Pt/C", "Pt/C", "LaCoO3", "Fe-N-C"]
    return {
        "DOI": f"10.1/{i}", "time": [2000 + i], "task1": {"reaction_catalog": [{"reaction_id": "R1", "reaction_name_reported": "x", "reaction_domain": "d", "reaction_class": "c", "reaction_family": ["OER" if i % 2 else "HER"]}]},
        "task2": {"catalyst_catalog": [{"catalyst_id": "C1", "name_reported": names[i % 4], "tested_reaction_ids": ["R1"], "labels_material_platform": ["a b", f"p{i % 3}"], "labels_active_site_form": ["site"]}]},
        "task3": {}, "task4": {}, "task5": {}, "task6": {},
    }


def test_batches_equal_one_build(spark, tmp_path):
    rows = [_paper(i) for i in range(7)]
    names = [layers.PAPERS, layers.COOCCURRENCE, layers.TEMPLATES, layers.FAMILIES, layers.LABELS]
    store = layers.LayerStore(spark, str(tmp_path / "store"), names, buckets=2)

    def add(number, papers):
        layer = build.staged(instance.build_instance_layer(papers), str(tmp_path / f"layer-{number}-{papers.count()}"))
        onto, onto_edges = ontology.build_ontology_layer(layer.nodes)
        return layers.add_papers(store, number, layer, onto_edges, onto)

    add(0, _papers(spark, rows[:3]))
    second = add(1, _papers(spark, rows[2:], 2))  # one paper again
    assert add(1, _papers(spark, rows[:5])) == [] and {x["layer"] for x in second} == {m.name for m in names}
    assert next(x for x in second if x["layer"] == "papers")["rows_read"] <= 3
    with pytest.raises(ValueError):
        store.commit(-1, {})
    whole = build.staged(instance.build_instance_layer(_papers(spark, rows)), str(tmp_path / "whole"))
    onto, onto_edges = ontology.build_ontology_layer(whole.nodes)
    cols = ["source", "target", "edge_type", "co_occurrence_count", "witness_paper_count", "first_year", "last_year"]
    likely = bridge.build_cooccurrence(whole.edge_tables, onto_edges, onto, whole.nodes["Paper"])
    assert sorted(map(tuple, store.read("cooccurrence").select(cols).collect())) == sorted(map(tuple, likely.select(cols).collect()))
    templates, _ = canonical.build_reaction_templates(whole.nodes["Reaction"])
    assert {("rule:" + r["key"], r["instance_count"], tuple(r["ord"])) for r in store.read("templates").collect()} == {(r["merge_key"], r["instance_count"], tuple(r["ord"])) for r in templates.collect()}
    assert sum(r["instance_count"] for r in store.read("families").collect()) == 7
    counts = Counter()
    for r in store.read("labels").collect():
        counts[r["label"]] += r["n"]
    assert counts == {"a b": 7, "site": 7, "p0": 3, "p1": 2, "p2": 2}
    assert all(r["labels"][0] in ("a b", "site") for r in layers.dominant_labels(store.read("labels")).collect())


def test_failed_batch_runs_again(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path / "store"), [layers.LABELS], buckets=2)
    rows = spark.createDataFrame([("k", "f", "x", 2, [1])], "key string, field string, label string, n long, first array<int>")
    store.commit(0, {"labels": rows})
    rows.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{store.path}/labels/batch=1")  # left by a run that died before its commit
    rows.limit(0).write.parquet(f"{store.path}/commits/batch=1")
    (tmp_path / "store/commits/batch=1/_SUCCESS").unlink()
    assert [r["n"] for r in store.read("labels").collect()] == [2]
    store.commit(1, {"labels": rows})
    assert [r["n"] for r in store.read("labels").collect()] == [4]
