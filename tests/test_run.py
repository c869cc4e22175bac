from __future__ import annotations

import json

from tesserae.operators import normalize
from tesserae.plans import run

from .test_graph import FX1


def name_reactions(rows):
    return [{"uid": r["uid"], "canonical_reaction_name": "Oxygen Evolution", "canonical_reaction_aliases": ["OER"]} for r in rows]


def name_catalysts(rows):
    return [{"uid": r["uid"], "canonical_catalyst_name": r["name_reported"], "canonical_catalyst_family": r["name_reported"].replace("5 wt% ", "sup-")} for r in rows]


def one_family(rows):
    return [{"family": r["family"], "canonical": "LaCoO3"} for r in rows]


def test_full_run_with_normalisers(spark, tmp_path):
    source = tmp_path / "papers.jsonl"
    source.write_text("\n".join(map(json.dumps, FX1)) + "\n")
    options = run.RunOptions(str(source), str(tmp_path / "out"), batches=normalize.Options(batch=1, concurrency=1))
    stats = run.run(spark, options, name_reactions, name_catalysts, one_family)
    assert stats["summary"]["total_nodes"] == 20 and stats["catalyst_families"]["count"] == 1 and stats["reaction_templates"]["count"] == 1
    assert json.loads((tmp_path / "out/stats.json").read_text()) == json.loads(json.dumps(stats))
    assert "nodes 20" in (tmp_path / "out/report.txt").read_text()
    bundles = spark.read.json(str(tmp_path / "out/paper_bundles")).collect()
    assert sorted(len(b["nodes"]) for b in bundles) == [3, 9]
    tasks = {(r["task"], r["edge_type"]): r["n"] for r in spark.read.json(str(tmp_path / "out/explorer/task_groups")).collect()}
    assert tasks["bridge", "LIKELY_ASSOCIATED_WITH"] == 9 and tasks["task6", "HAS_TAG"] == 0
    assert {r["canonical"] for r in spark.read.json(str(tmp_path / "out/family_map")).collect()} == {"LaCoO3"}
    again = run.run(spark, run.RunOptions("", str(tmp_path / "out"), viewers_only=True))
    assert again["summary"] == stats["summary"]
