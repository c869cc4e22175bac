"""SimHash groups, line dedup and decontamination against brute force."""

from __future__ import annotations

import os
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tesserae.llm import decontam, lines, simhash
from tesserae.llm.components import connected_components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for t in (None, "", "  \t", "One", "one TWO", "a b c", "Ünï a b Ünï a b c\n\x0bx", "w " * 50):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("dense, segments", [(1, 2), (128, 2), (1, 3), (128, 3)])
def test_links_connect_what_brute_force_connects(spark, dense, segments):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints)[:8]:
        for _ in range(25):
            q = p
            for _ in range(rng.randint(1, 3)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), dense=dense, segments=segments)
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = brute_roots(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    got = {p: roots.get(p, p) for p in signed}
    assert {frozenset(k for k in signed if got[k] == g) for g in set(got.values())} == {frozenset(k for k in signed if want[k] == g) for g in set(want.values())}


@pytest.mark.parametrize("segments", [2, 3])
def test_keys_are_made_where_they_meet(spark, segments):
    """A fingerprint travels by its places, not by its keys, and equal keys are in one partition."""
    fps = spark.range(64).selectExpr("shiftleft(1L, cast(id as int)) as fp").union(spark.createDataFrame([(0,)], "fp long"))
    keys = simhash.segment_keys(fps, segments, 7).withColumn("at", F.spark_partition_id())
    assert keys.groupBy("key").agg(F.count_distinct("at").alias("n")).where("n > 1").count() == 0
    widths = [len(m) for m in simhash._masks(segments)]
    assert keys.count() == 65 * sum(w + 1 for w in widths)  # each variant once
    plan = simhash.segment_keys(fps, segments)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(") < plan.index("Repartition") < plan.index("inline(")


def test_near_duplicates(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(6)]
    texts = base + [b + " tail" for b in base] + base[:2] + ["", None, "  ", "One two", "one TWO"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(None, base[0]), (1, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    prints = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    roots = brute_roots(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    for r in got:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == roots[r["doc_id"]]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert connected_components(edges.limit(0)).count() == 0


def within_one(a, b):
    """Whether the longer of two word lists has five words or more and they are one edit apart, or less."""
    return max(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(docs):
    """place -> (kept place, distance), as the operator defines it."""
    seen, out = {}, {}
    for d in sorted(docs, key=lambda r: r[0]):
        for n, line in enumerate((d[1] or "").split("\n")):
            key = " ".join(line.lower().split())
            if key:
                seen.setdefault(key, []).append((d[0], n))
    first = {min(v): k for k, v in seen.items()}
    for place, key in first.items():
        p = key.split()
        near = [q for q, other in first.items() if q < place and other != key and within_one(p, other.split())]
        for copy in seen[key]:
            if copy != place:
                out[copy] = (place, 0)
            elif near:
                out[copy] = (min(near), 1)
    return out


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_duplicate_lines(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    monkeypatch.setattr(lines, "HOT_KEY", 2 if broadcast else 10_000)
    rng = random.Random(11)
    pool = [f"word{i}," for i in range(12)]
    docs = []
    made = []
    for d in range(40):
        own = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choices(pool, k=rng.randint(1, 9))
            if made and rng.random() < 0.7:
                p = list(rng.choice(made))
                kind = rng.random()
                if p and kind < 0.3:
                    p[rng.randrange(len(p))] = rng.choice(pool)
                elif p and kind < 0.5:
                    del p[rng.randrange(len(p))]
                elif kind < 0.7:
                    p.insert(rng.randrange(len(p) + 1), rng.choice(pool))
            made.append(p)
            own.append("  ".join(p) if rng.random() < 0.2 else " ".join(p).upper() if rng.random() < 0.2 else " ".join(p))
        docs.append((d * 2, "\n".join(own)))
    docs += [(101, None), (102, ""), (103, "\n\n \n")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs] + [(None, "some words", "y", 2)], "doc_id long, text string, line string, key int")
    got = {(r["doc"], r["line"]): ((r["kept_doc"], r["kept_line"]), r["distance"]) for r in lines.duplicate_lines(df).collect()}
    want = brute_lines(docs)
    assert any(v[1] for v in want.values()) and got == want
    left = {r["doc_id"]: r for r in lines.dedup_lines(df, length_col=None).collect()}
    for i, text in docs:
        own = [x for n, x in enumerate((text or "").split("\n")) if (i, n) not in want]
        if any((i, n) in want for n in range(99)):
            assert ("\n".join(own) == left[i]["text"]) if "".join(own).strip() else i not in left
        else:
            assert left[i]["text"] == text
    assert left[None]["text"] == "some words" and left[101]["line"] == "x"
    assert lines.duplicate_lines(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_lines_of_the_tables_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = {}
    for d, t in sorted((r for r in docs.collect()), key=lambda r: r[0]):
        for n, line in enumerate((t or "").split("\n")):
            if line.split():
                first.setdefault(" ".join(line.lower().split()), (d, n))
    rows = [(place, norm.split()) for norm, place in first.items()]
    want = {}
    for k, (place, a) in enumerate(rows):
        for q, b in rows[:k]:
            if max(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                want[place] = min(q, want.get(place, q))
    got = {(r["doc"], r["line"]): (r["kept_doc"], r["kept_line"]) for r in lines.duplicate_lines(docs).where("distance = 1").collect()}
    assert want and {p: q for p, q in got.items() if p in first.values()} == want


def one_edit(a, b):
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[n + 1 :] == b[n + 1 :] or a[n + 1 :] == b[n:] or a[n:] == b[n + 1 :]


def test_lines_at_their_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, long.replace("w777 ", "x ")), (3, long.replace("w777 ", "")), (4, "a b c d"), (5, "a b c e"), (6, "a b x c d"), (7, "a a a a a a"), (8, "a a a a a a a"), (8, None), (9, "\u00c4 b c d e f"), (9, "\u00e4  B c d\te f")]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, norm string")
    got = {(r["doc"], r["line"]): (r["kept_doc"], r["distance"]) for r in lines.duplicate_lines(df).collect()}
    assert got == {(2, 0): (1, 1), (3, 0): (1, 1), (6, 0): (4, 1), (8, 0): (7, 1)}  # rows of one id and place are one line


def best_match(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@pytest.mark.parametrize("block", [200, 1_000_000])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK", block)
    rng = random.Random(2)
    letters = "abcde "
    rand = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, decontam.normal(rand(rng.randint(20, 90)))) for i in range(12)] + [(90, "abc"), (91, None), (92, "  ")]
    docs = []
    for d in range(60):
        t = rand(150)
        if d % 2:
            s = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, int(len(s) * 0.13))):
                k = rng.randrange(len(s))
                s[k : k + 1] = rng.choice([[], [rng.choice(letters)], [s[k], "e"]])
            t = rand(40) + "".join(s).upper() + "\n" + rand(30)
        docs.append((d, t))
    docs += [(100, None), (101, ""), (102, items[0][1])]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs.append((103, "xx " + items[1][1] + " " * 5 + "y " * 100_000 + items[1][1]))
    df = df.unionByName(spark.createDataFrame([(*docs[-1], 5)], df.schema))
    rows = decontam.leaks(df, bench).collect()
    got = {(r[0], r[1]): r[2] for r in rows}
    for r in rows:  # the places are those of the occurrence
        assert distance(dict(items)[r["item_id"]], decontam.normal(dict(docs)[r["doc_id"]])[r["start"] : r["end"]]) == r["distance"]
    tie = next(r for r in rows if (r["doc_id"], r["item_id"]) == (103, 1))
    assert (tie["distance"], tie["start"], tie["end"]) == (0, 3, 3 + len(items[1][1]))
    want = {}
    for d, t in docs:
        for i, s in items:
            if s and s.strip() and d != 103:
                m = best_match(s, decontam.normal(t))
                if m <= int(len(s) * decontam.RATE):
                    want[d, i] = m
    assert {k: v for k, v in got.items() if k[0] != 103} == want and any(want.values())
    assert decontam.leaks(df, bench.limit(0)).count() == 0 and decontam.leaks(df.limit(0), bench).count() == 0


def test_component_edges_stay_few(spark):
    star = spark.range(1, 2000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert connected_components(star).where("root = 0").count() == 2000
