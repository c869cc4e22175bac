from __future__ import annotations

import json

from tesserae.operators import fetch, normalize, post, readmodel
from tesserae.streaming import ingest

from .test_graph import FX1


def fetch_page(query, offset, size):
    total = 25
    return [{"paperId": str(i), "externalIds": {"DOI": f"10.1/{i}"}, "title": query, "authors": [{"name": "A B"}]} for i in range(offset, min(total, offset + size))]


def fetch_with_total(query, offset, size):
    if query == "fails" and offset:
        raise OSError("down")
    return {"data": fetch_page(query, offset, size) if query != "short" or not offset else [], "total": 12 if query == "total" else 99}


def failing(rows):
    if any(r["uid"] == "r3" for r in rows):
        raise RuntimeError("down")
    return [{"uid": r["uid"], "canonical_reaction_name": f" {r['name']} "} for r in rows] + [{"uid": "stranger", "canonical_reaction_name": "x"}]


def test_normalizer_failures_and_resume(spark, tmp_path):
    queue = spark.createDataFrame([(f"r{i}", f"n{i}") for i in range(4)], "uid string, name string").coalesce(1)
    options = normalize.Options(batch=1, concurrency=2, attempts=2, backoff=0.0)
    out = {r["uid"]: r for r in normalize.normalize_reactions(queue, failing, options).collect()}
    assert set(out) == {"r0", "r1", "r2", "r3"} and out["r1"]["canonical_reaction_name"] == "n1"
    assert out["r3"]["status"].startswith("failed") and out["r3"]["canonical_reaction_name"] == ""
    schema = "uid string, canonical_reaction_name string, canonical_reaction_aliases array<string>, status string"
    asked = []

    def step(rest):
        asked.append(sorted(r["uid"] for r in rest.collect()))
        return normalize.normalize_reactions(rest, failing, options)

    for _ in range(2):
        done = normalize.resume(queue, str(tmp_path / "done"), step, schema)
    assert asked == [["r0", "r1", "r2", "r3"], ["r3"]] and done.count() == 3


def test_answers():
    assert normalize.parse_rows('```json\n[{"a": 1}, 2]\n```') == [{"a": 1}]
    assert normalize.prompt([{"uid": "u", "x": ["a", "b"], "y": ""}], ["x", "y"]) == "[1] uid: u\n    x: a, b"


def test_transitive_map(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), ("p", "q"), ("q", "p")], "family string, canonical string")
    got = {r[0]: r[1] for r in normalize.resolve_map(df).collect()}
    assert got == {"a": "c", "b": "c", "c": "c", "p": "q", "q": "p"}
    answers = spark.createDataFrame([("a", "x"), ("a", "y"), ("zz", "x"), ("b", " ")], "family string, canonical string").coalesce(1)
    assert {r[0]: r[1] for r in normalize.complete_map(df, answers).collect()} == {"a": "x", "b": "b", "c": "c", "p": "p", "q": "q"}


def test_rollup_and_rewrite(spark):
    rows = [("1", "n1", "F", ["x"], ""), ("2", "n2", "F", [], ""), ("3", "n1", "F", [], ""), ("4", "", "", [], "G")]
    df = spark.createDataFrame(rows, "uid string, canonical_catalyst_name string, canonical_catalyst_family string, canonical_aliases array<string>, canonical_name string").coalesce(1)
    assert [(r["family"], r["members_sample"], r["count"]) for r in normalize.family_rollup(df).collect()] == [("F", ["n1", "n2"], 3), ("G", ["G"], 1)]
    m = spark.createDataFrame([("F", "H")], "family string, canonical string")
    assert [r["canonical_catalyst_family"] for r in normalize.rewrite_families(df, m).orderBy("uid").collect()] == ["H", "H", "H", ""]


def test_paged_search(spark):
    out = fetch.search(spark, "q", f"{__name__}:fetch_page", limit=22, page=10)
    assert [r["doi"] for r in out.collect()] == [f"10.1/{i}" for i in range(22)]


def test_paging_stops(spark):
    place = f"{__name__}:fetch_with_total"
    for query, n in (("all", 25), ("fails", 10), ("short", 10), ("total", 20)):  # the last page's results all count
        assert fetch.search(spark, query, place, limit=40, page=10).count() == n
    rows = spark.read.format("paged_search").options(query="q", fetcher=f"{__name__}:fetch_page", limit="25", page="10", parallel="true").load()
    assert sorted(r["place"] for r in rows.collect()) == list(range(25))


def test_resume_commits_each_group(spark, tmp_path):
    import pytest

    queue = spark.createDataFrame([(f"r{i}", f"n{i}") for i in range(40)], "uid string, name string")
    schema = "uid string, canonical_reaction_name string, canonical_reaction_aliases array<string>, status string"
    steps = []

    def step(rest):
        steps.append(rest.count())
        if len(steps) == 3:
            raise RuntimeError("crash")
        return normalize.normalize_reactions(rest, lambda rows: [{"uid": r["uid"], "canonical_reaction_name": "n"} for r in rows], normalize.Options(batch=5, concurrency=1))

    with pytest.raises(RuntimeError):
        normalize.resume(queue, str(tmp_path / "done"), step, schema, flush=10)
    kept = spark.read.parquet(str(tmp_path / "done")).count()
    assert kept == sum(steps[:2]) > 0  # what was answered before the crash is there
    assert normalize.resume(queue, str(tmp_path / "done"), step, schema, flush=10).count() == 40 and sum(steps[3:]) == 40 - kept


def test_neighbours_across_ranges(spark):
    df = spark.createDataFrame([(i * 7 % 50, f"n{i % 3}") for i in range(50)], "k int, name string")
    order = sorted((r["name"], r["k"]) for r in df.collect())
    for ranges in (1, 4, 60):
        got = {r["k"]: (r["previous"], r["next"]) for r in readmodel.neighbours(df, ["name", "k"], "k", ranges).collect()}
        keys = [k for _, k in order]
        assert got == {k: (keys[i - 1] if i else None, keys[i + 1] if i < 49 else None) for i, k in enumerate(keys)}


def test_places_of_streamed_lines(spark, tmp_path):
    rows = [(5, "a", 0, 1), (5, "a", 0, 2), (5, "a", 64, 3), (5, "b", 0, 4), (6, "a", 0, 5)]
    batch = spark.createDataFrame(rows[::-1], "paper_ord long, __file string, __block long, n int").repartition(3, "__file", "__block").sortWithinPartitions("__file", "__block", "n")
    got = ingest.placed(batch).orderBy("paper_ord").collect()
    assert [r["n"] for r in got] == [1, 2, 3, 4, 5] and [r["paper_ord"] for r in got] == [5000000, 5000001, 5000002, 5000003, 6000000]


def test_doi_fallback_and_state(spark):
    dois = spark.createDataFrame([(i, d) for i, d in enumerate(["d1", "d2", "d3"])], "ord int, doi string")
    primary = spark.createDataFrame([("d1", json.dumps({"paperId": "1", "title": "T One", "year": 2001, "authors": [{"name": "Ann Lee"}]}))], "doi string, body string")
    cross = spark.createDataFrame([("d2", json.dumps({"message": {"title": ["T Two"], "author": [{"given": "Bo", "family": "Ek"}], "published-online": {"date-parts": [[2002, 1]]}}}))], "doi string, body string")
    recs = fetch.resolve_dois(dois, primary, cross)
    assert [(r["title"], r["year"], r["authors"]) for r in recs.collect()] == [("T One", 2001, ["Ann Lee"]), ("T Two", 2002, ["Bo Ek"]), ("Unknown (d3)", None, [])]
    attempts = spark.createDataFrame([("d1", "unpaywall", 2, True), ("d1", "semantic_scholar_oa", 1, False), ("d2", "unpaywall", 2, True)], "doi string, source string, rank int, ok boolean")
    there = spark.createDataFrame([("2002_Ek_T_Two.pdf",)], "filename string")
    state = fetch.download_state(recs, attempts, there).orderBy("ord")
    assert [(r["download_status"], r["download_source"]) for r in state.collect()] == [("success", "unpaywall"), ("skipped_exists", "local"), ("failed", None)]
    made = fetch.index(state.drop("ord"), "t", "2020-01-01")
    assert made["stats"] == {"total": 3, "downloaded": 1, "failed": 1, "skipped": 1} and "T Two" in fetch.report(made)


def test_links_and_retry(spark):
    bodies = [{"best_oa_location": {"url_for_pdf": "a.pdf"}}, {"best_oa_location": {"url": "page"}, "oa_locations": [{}, {"url_for_pdf": "b"}]}, {}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "i int, b string")
    assert [r[0] for r in df.orderBy("i").select(fetch.oa_link(df["b"])).collect()] == ["a.pdf", "b", None]
    waits, answers = [], iter([(429, ""), (429, ""), (200, "ok")])
    assert fetch.get_with_retry(lambda u: next(answers), "u", waits.append) == (200, "ok") and waits == [2, 4]


def test_dangling_and_search(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "uid string")
    edges = spark.createDataFrame([("a", "b", "t"), ("a", "b", "t"), ("a", "x", "t"), ("y", "b", "t")], "source string, target string, edge_type string")
    assert post.valid_edges(nodes, post.dedup_edges(edges)).count() == 1 and post.dangling_edges(nodes, edges).count() == 2
    assert readmodel.search(edges, "X").count() == 1 and readmodel.search(edges, "B", ["target"]).count() == 3


def test_stream_ingest_twice(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n, paper in enumerate(FX1):
        (inbox / f"{n}.jsonl").write_text(json.dumps(paper) + "\n")
        ingest.ingest(ingest.stream_papers(spark, str(inbox)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/nodes/Paper")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out/nodes/OntologyTerm")).select("uid").distinct().count() == 6
