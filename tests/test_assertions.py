"""Step patterns, conflicting assertions and the file sink, each against a plain version."""

from __future__ import annotations

import itertools
import json
import random
from collections import Counter, defaultdict

import pytest

from tesserae.operators import bins, conflicts, instance, negatives, sequences
from tesserae.sources import files, io


def plain_patterns(rows, least, longest):
    has = {tuple(s): {c for n in range(1, longest + 1) for c in itertools.combinations([x for x in s if x is not None], n)} for _, s in rows if s}
    each = [(i, has[tuple(s)]) for i, s in rows if s]
    count = Counter(p for _, ps in each for p in ps)
    return {p: n for p, n in count.items() if n >= least}, each


@pytest.mark.parametrize("least", [2, 5, 1000])
def test_patterns_equal_all_subsequences(spark, least):
    rnd = random.Random(least)
    rows = [(i, [rnd.choice(["a", "b", "c", "d", None]) for _ in range(rnd.randrange(7))]) for i in range(40)] + [(90, None), (91, []), (92, ["x"] * 6), (93, ["x"] * 6)]
    df = spark.createDataFrame([(i, s, "p") for i, s in rows], "id long, items array<string>, pattern string")
    want, each = plain_patterns(rows, least, 4)
    patterns, members = sequences.frequent_patterns(df, least, 4)
    assert {tuple(r["pattern"]): r["support"] for r in patterns.collect()} == want
    assert Counter((r["id"], tuple(r["pattern"])) for r in members.collect()) == Counter((i, p) for i, ps in each for p in ps if p in want)
    nodes, edges = sequences.procedure_templates(df, least, 4)
    best = {i: min((-len(p), -want[p], p) for p in ps if p in want)[2] for i, ps in each if any(p in want for p in ps)}
    names = {r["uid"]: tuple(r["pattern"]) for r in nodes.collect()}
    assert {r["source"]: names[r["target"]] for r in edges.collect()} == best
    assert {tuple(r["pattern"]): r["instance_count"] for r in nodes.collect()} == Counter(best.values())


def test_sequences_of_a_graph(spark):
    steps = [{"step_no": k, "step_type": t} for k, t in ((1, "Mixing"), (2, "calcination "), (3, ""))]
    paper = {"DOI": "10.1/A", "task3": {"procedure_catalog": [{"procedure_id": "P1", "steps": steps}]}}
    layer = instance.build_instance_layer(io.papers_from_rows(spark, [paper]))
    assert [r["items"] for r in sequences.graph_sequences(layer.nodes, layer.edge_tables).collect()] == [["mixing", "calcination"]]


def test_conflicts_equal_plain_cells(spark):
    rnd = random.Random(1)
    rows = [(f"u{i}", rnd.choice(["p", "q", None]), rnd.randrange(4), rnd.choice([-1, 0, 1, 1, None]), i % 7, f"e{i}") for i in range(60)] + [(f"h{i}", "hot", 0, 1 if i else -1, i, "e") for i in range(200)]
    df = spark.createDataFrame(rows, "uid string, subject string, bin int, sign int, ord int, evidence string")
    cells = defaultdict(list)
    for r in rows:
        if r[1] and r[3]:
            cells[r[1], r[2]].append(r)
    want = set()
    for (s, b), own in cells.items():
        for r in own:
            other = sorted((x[4], x[0]) for x in own if x[3] == -r[3])
            if other:
                want.add((s, b, r[0], other[0][1], len(other), r[5]))
    got = conflicts.conflict_edges(df, ["subject", "bin"], evidence="evidence").drop("edge_type").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert conflicts.conflict_edges(df.limit(0), ["subject", "bin"]).count() == 0


def test_claims_explain_measured_properties(spark):
    claims = spark.createDataFrame([("k1", "c", "r"), ("k1", "c", "r"), ("k2", "c", "x"), ("k3", None, "r")], "claim string, catalyst string, reaction string")
    metrics = spark.createDataFrame([("m1", "c", "r", "fe"), ("m1", "c", "r", "fe"), ("m2", "c", "r", "fe"), ("m3", "c", "r", "tof")], "metric string, catalyst string, reaction string, property string")
    assert sorted((r["source"], r["target"], r["support"]) for r in conflicts.explained_properties(claims, metrics).collect()) == [("k1", "fe", 2), ("k1", "tof", 1)]


def test_files_appear_together_and_in_order(spark, tmp_path):
    files.register(spark)
    rows = [(i, f"dir/f{i % 15}.pdf", b"%PDF" + bytes([i]) * i if i % 4 else b"<html>") for i in range(20)] + [(20, "null.pdf", None), (21, None, b"%PDF!")]
    df = spark.createDataFrame(rows, "ordinal long, name string, content binary").repartition(5)
    df.write.format("tesserae_files").mode("append").option("path", str(tmp_path)).option("magic", "%PDF").save()
    lines = [json.loads(x) for x in next(tmp_path.glob("manifest-*.jsonl")).read_text().splitlines()]
    assert [x["ordinal"] for x in lines] == list(range(22))
    last = {n.rpartition("/")[2] if n else f"unnamed-{i}": (i, c) for i, n, c in rows if c and c.startswith(b"%PDF")}
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir() if not p.name.startswith("manifest")} == {n: c for n, (_, c) in last.items()}
    assert all(x["status"] == ("refused" if not rows[i][2] or not rows[i][2].startswith(b"%PDF") else "written" if last[x["name"]][0] == i else "replaced") for i, x in enumerate(lines))


def test_failed_write_leaves_no_file(spark, tmp_path):
    files.register(spark)
    df = spark.range(20).selectExpr("id as ordinal", "concat('f', id) as name", "cast(if(id = 19, cast(raise_error('broken') as string), 'x') as binary) as content").repartition(4)
    with pytest.raises(Exception, match="broken"):
        df.write.format("tesserae_files").mode("append").option("path", str(tmp_path / "out")).save()
    assert not (tmp_path / "out").exists() or list((tmp_path / "out").iterdir()) == []


def test_negatives_are_absent_and_matched(spark):
    rnd = random.Random(2)
    pairs = [(f"s{rnd.randrange(12)}", f"t{min(int(rnd.expovariate(0.2)), 30)}") for _ in range(150)] + [(None, "t1"), ("s1", None)]
    later = [(f"s{k}", "t0") for k in range(12)]
    frame = lambda rows: spark.createDataFrame(rows, "source string, target string")
    got = negatives.hard_negatives(frame(pairs).repartition(3), known=frame(later)).collect()
    links = {p for p in pairs if None not in p}
    assert got and all((r["source"], r["negative"]) not in links | set(later) and (r["source"], r["target"]) in links for r in got)
    assert len(got) >= 0.8 * len(links) and len({(r["source"], r["target"]) for r in got}) == len(got)
    assert {tuple(r) for r in got} == {tuple(r) for r in negatives.hard_negatives(frame(pairs[::-1]), known=frame(later)).collect()}  # the seed alone decides
    assert negatives.hard_negatives(frame([])).count() == 0
    places = negatives.numbered(spark.range(0, 500, 7), ["id"], ranges=4)
    assert {r["id"]: r["place"] for r in places.collect()} == {7 * k: k for k in range(72)}


def test_bins_of_merged_sketches(spark):
    rnd = random.Random(9)
    values = [rnd.gauss(0, 1) for _ in range(20_000)]
    rows = [("p", i % 5, v) for i, v in enumerate(values)] + [("q", 0, 1.0)] * 30 + [("q", 1, None), ("q", 1, float("nan")), ("none", 0, None), (None, 0, 2.0)]
    df = spark.createDataFrame(rows, "property string, shard int, v double")
    shards = bins.sketches(df, ["property", "shard"], "v")
    edges = bins.bin_edges(bins.merged(shards, ["property"]), ["property"], 20)
    got = {r["property"]: r["edges"] for r in edges.collect()}
    values.sort()
    for k, e in enumerate(got["p"]):
        assert abs(sum(v <= e for v in values) / len(values) - (k + 1) / 20) < 0.01  # the stated rank error, some 0.4 %, and a margin
    whole = {r["property"]: r["edges"] for r in bins.bin_edges(bins.merged(bins.sketches(df, ["property"], "v"), ["property"]), ["property"], 20).collect()}
    assert all(abs(sum(v <= a for v in values) - sum(v <= b for v in values)) < 0.02 * len(values) for a, b in zip(got["p"], whole["p"], strict=True))
    assert got["q"] == [1.0] * 19 and "none" not in got
    thirds = bins.bin_edges(bins.merged(shards, ["property"]), ["property"], 3)
    named = Counter((r["property"], r["outcome"]) for r in bins.outcome_labels(df, thirds, ["property"], "v").collect())
    assert named["q", None] == 2 and named["none", None] == 1 and all(abs(named["p", x] / 20_000 - 1 / 3) < 0.01 for x in bins.LABELS)
