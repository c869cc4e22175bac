"""Shared rates and download states against plain loops, over two batches with a restart between them."""

from __future__ import annotations

import random

import numpy as np

from tesserae.streaming import rates
from tesserae.streaming.ingest import to_table


def plain(times, gap, burst):
    """A bucket of tokens, request by request."""
    tokens, now, out = float(burst), None, []
    for t in times:
        at = t if now is None else max(t, now)
        if now is not None:
            tokens = min(burst, tokens + (at - now) / gap)
        wait = max(0.0, (1 - tokens) * gap)
        now, tokens = at + wait, tokens + wait / gap - 1
        out.append(now)
    return out


def test_releases_equal_a_token_bucket():
    rnd = random.Random(3)
    for _ in range(200):
        gap, burst = rnd.choice([10, 16]), rnd.choice([1, 2, 5])
        times = np.cumsum([rnd.choice([0, 0, 1, 3, 40, 200]) for _ in range(60)])
        cut = rnd.randrange(1, 60)
        first, full = rates.releases(times[:cut], rates.NEVER, gap, burst)
        then = rates.releases(times[cut:], full, gap, burst)[0] if cut < 60 else times[:0]
        assert np.allclose([*first, *then], plain(times.tolist(), gap, burst))


def _batch(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(2).write.mode("append").parquet(path)


def test_one_rate_over_a_restart(spark, tmp_path):
    rnd = random.Random(5)
    schema = "service string, id long, at timestamp_ntz"
    source, place = str(tmp_path / "in"), str(tmp_path / "out")
    second = lambda k: f"timestamp_ntz'2024-01-01 00:{k // 60:02d}:{k % 60:02d}'"
    every = [[(f"s{rnd.randrange(2)}", 100 * b + i, 300 * b + rnd.randrange(250)) for i in range(60)] for b in range(2)]
    for rows in every:
        df = spark.createDataFrame(rows, "service string, id long, k int").selectExpr("service", "id", f"{second(0)} + make_dt_interval(0, 0, 0, k) as at")
        df.unionByName(df.limit(1).selectExpr("cast(null as string) as service", "id", "at")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        out = to_table(rates.scheduled(stream, "service", "id", "at", 7, 2), f"{place}/t", f"{place}/state")  # a new query goes on from the checkpoint
    base = min(r["arrived"] for r in out.collect()) - 1_000_000 * min(k for _, _, k in every[0])
    got = {r["id"]: (r["release"] - base) / 1e6 for r in out.collect()}
    assert len(got) == 120
    for s in ("s0", "s1"):
        own = [x for rows in every for x in sorted((r for r in rows if r[0] == s), key=lambda r: (r[2], r[1]))]
        assert np.allclose([got[i] for _, i, _ in own], plain([k for _, _, k in own], 7, 2))


def test_downloads_end_or_are_tried_again(spark, tmp_path):
    source, place = str(tmp_path / "in"), str(tmp_path / "out")
    seen = {}
    for rows in ([("a", False), ("b", True), ("c", False), (None, True)], [("a", True), ("b", False), ("c", None), ("c", False)]):
        _batch(spark, source, rows, "doi string, ok boolean")
        stream = rates.download_states(spark.readStream.schema("doi string, ok boolean").parquet(source), "doi", "ok")
        collected = []
        query = stream.writeStream.outputMode("update").foreachBatch(lambda df, _, to=collected: to.extend(df.collect())).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        seen.update({r["doi"]: (r["attempts"], r["status"]) for r in collected})
    assert seen == {"a": (2, "done"), "b": (1, "done"), "c": (3, "failed")}
