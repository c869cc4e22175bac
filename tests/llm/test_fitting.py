"""Resampling, vector codes and packing, each against a plain version."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import codes, packing, queries, resampling

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain_grams(text, order=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain_resampling(docs, target, percent, least, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in plain_grams(x)[1]) for texts in ([x for _, x in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        words, grams = plain_grams(x)
        weight = sum(gain[bucket(g)] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), len(grams), weight, score))
    able = sorted((-r[4], r[0]) for r in rows if r[1] >= least and r[4] is not None)
    rank = {i: n + 1 for n, (_, i) in enumerate(able[: percent * len(able) // 100])}
    return {(*r, rank.get(r[0])) for r in rows}


ODD = [None, "", " ", "Aé ÄZ a1_b2 c-D e's 😀x ﬁ", "w" * 63 + " " + "v" * 64 + " " + "u" * 65 + " " + "é" * 500 + " Z", "a", "a b", "\x00\x7f{}`@[", "漢字 かな\x7fx"]


def test_resampling_equals_plain_version(spark):
    rnd = random.Random(5)
    docs = list(enumerate(ODD)) + [(100 + i, " ".join(rnd.choice(["the", "Of", "and", "x9", "élan", "q" * 30]) for _ in range(rnd.randrange(60)))) for i in range(300)]
    target = ["the of and", None, "", "élan the x9 X9"]
    df = spark.createDataFrame([(i, x, 1, "s") for i, x in docs], "doc_id long, text string, rank int, score string")
    got = resampling.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), least_words=5)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert {tuple(r) for r in got.collect()} == plain_resampling(docs, target, 25, 5)


def test_resampling_of_odd_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, target).count() == 0
    text = "word " * 30
    df = spark.createDataFrame([(1, text)] * 8 + [(None, text)], "doc_id long, text string")
    rows = resampling.resample(df, none).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2] and len(rows) == 9  # equal rows: any two of them
    assert [r["score"] for r in rows if r["doc_id"] is None] == [None]
    ties = spark.createDataFrame([(i, 40, 79, 0, 5 if i % 2 else 6) for i in range(20)], "id long, n_words long, n_features long, weight long, score long")
    drawn = {r["id"]: r["rank"] for r in resampling.draw(ties, percent=60).collect() if r["rank"]}
    assert drawn == {**{2 * k: k + 1 for k in range(10)}, 1: 11, 3: 12}


def test_crcs_compose_to_any_order(monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK", 4)
    texts = [x or "" for x in ODD] + ["a b c d e f g h i j " + "x" * 200 + " y"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(x.encode()) for x in texts])
    got = defaultdict(list)
    for _, text, crcs in resampling.features(data, ends, resampling.CrcAlgebra(), 4):
        for i, c in zip(text.tolist(), crcs.tolist(), strict=True):
            got[i].append(c)
    for i, x in enumerate(texts):
        assert sorted(got[i]) == sorted(zlib.crc32(g.encode()) for g in plain_grams(x, 4)[1])


def plain_nearest(part, book):
    found = [min((sum((int(x) - int(y)) ** 2 for x, y in zip(p, b, strict=True)), e) for e, b in enumerate(book)) for p in part]
    return [e for _, e in found], [d for d, _ in found]


@pytest.mark.parametrize("width,spread,kind", [(16, 300, np.int64), (3, 4, np.int64), (1, 3, np.int64), (16, 1 << 26, np.int64), (5, 1 << 40, object)])
def test_filters_lose_no_nearest_entry(width, spread, kind):
    rng = np.random.default_rng(width)
    book = rng.integers(-spread, spread, (60, width)).astype(kind)
    part = np.concatenate([rng.integers(-spread, spread, (200, width)).astype(kind), book[::-1], book + 1])
    seen = []
    code, error = codes.Codebook(book).nearest(part, seen)
    want = plain_nearest(part, book)
    assert code.tolist() == want[0] and [int(x) for x in error] == want[1]
    assert len(part) <= seen[-1] <= seen[0] <= len(part) * len(book)
    if width == 16:
        assert seen[-1] < seen[0] < len(part) * len(book)


def plain_compress(rows, entries, rounds):
    """rows: (id, vector, label) of one width, ids not null."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // 4
    parts = [[v[p * w : p * w + w] for _, v, _ in kept] for p in range(4)]
    books = [[v[p * w : p * w + w] for _, v, _ in sorted(kept, key=lambda r: (r[0], r[1]))[:entries]] for p in range(4)]
    for step in range(rounds + 1):
        near = [plain_nearest(parts[p], books[p]) for p in range(4)]
        if step < rounds:
            for p in range(4):
                for e in range(len(books[p])):
                    own = [v for v, c in zip(parts[p], near[p][0], strict=True) if c == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    label = Counter()
    for k, (_, _, lab) in enumerate(kept):
        label[lab] += sum(near[p][1][k] for p in range(4))
    digest = hashlib.sha256(",".join(str(x) for b in books for v in b for x in v).encode()).hexdigest()
    return Counter((i, "".join(f"{near[p][0][k]:02x}" for p in range(4)), sum(near[p][1][k] for p in range(4)), label[lab]) for k, (i, _, lab) in enumerate(kept)), digest


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_codes_equal_plain_version(spark, scale):
    rnd = random.Random(3)
    rows = [(i, [scale * rnd.gauss(i % 5, 0.3) for _ in range(8)], i % 3 or None) for i in range(60)] + [(7, [1.0] * 8, 1)] * 3
    bad = [(90, None, 1), (91, [1.0] * 7 + [None], 1), (-5, [float("nan")] * 8, 2), (-6, [float("inf")] + [0.0] * 7, 2)]
    df = spark.createDataFrame([(*r, "c") for r in rows + bad], "vec_id long, embedding array<double>, label int, code string").repartition(3)
    got, books = codes.compress(df, entries=20, rounds=2)
    want, digest = plain_compress(rows + bad, 20, 2)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got.collect()) == want and codes.digest(books) == digest
    near = codes.decode(got, books).where("vec_id < 60 and vec_id <> 7").join(df.select("vec_id", "embedding"), "vec_id").collect()
    assert len(near) == 59 and all(sum((math.floor(1024 * x) - round(1024 * y)) ** 2 for x, y in zip(r["embedding"], r["vector"], strict=True)) == r["error"] for r in near)


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)]):
        got, _ = codes.compress(spark.createDataFrame(rows, schema))
        assert got.count() == 0
    got, books = codes.compress(spark.createDataFrame([(None, [1.0, 2.0, 3.0], None), (1, [], None), (2, [0.5] * 5, 4)], schema), rounds=1)
    assert sorted((r["error"], r["label_error"]) for r in got.collect()) == [(0, 0)] * 3 and {b.shape for b in books} == {(3, 2)}


@needs_tables
@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_vector_codes"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF).select(want.columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.MODEL)
    return path, Tokenizer.from_file(path)


TEXTS = [
    "it's 's ''s don't  we'll\tA\x1cB é Éx ́ x\xa0y  İİ ΣΑΣ K 12a3 <|x", "<|endoftext|> a<|ENDOFTEXT|>b", "a\x00b \x85 ﻿q ​z 日本語。テスト 한국어 ﷺ ½ x²", None, "", " ", "\n\n a",
    "!!?$,.'s 'S 'Re IT'S $, a$. ,b, é. 1. 2,", "퟿\U0001f600‍\U0001f469 à́b", "nospace" * 4_000, "long words " * 5_000,
]


def test_ids_are_the_tokenizers():
    path, tk = tokenizer()
    rnd = random.Random(1)
    texts = [x or "" for x in TEXTS] + ["".join(rnd.choice("aAé́'sStTrevlmd .,!$\n\t\x1c\xa0 1½中İΣ<|‍😀\x00") for _ in range(60)) for _ in range(2000)]
    few = packing.ChunkEncoder(path, cache=50)
    for x in texts:
        assert np.frombuffer(few.encode(x), "<u4").tolist() == tk.encode(x, add_special_tokens=False).ids


def plain_best_fit(lengths, capacity):
    """Piece by piece: how many bins there are of each fill."""
    bins, room = [], []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
            room.append(capacity)
        bins[k].append(n)
        room[k] -= n
    return Counter(sum(b) for b in bins)  # bins of equal room are alike, so only their fill is determined


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 7, 16, 50, 100])
    lengths = [min(capacity, 1 + int(rnd.expovariate(rnd.choice([0.05, 0.2, 0.5])))) for _ in range(rnd.randrange(1, 300))]
    counts = Counter(lengths)
    runs, made = packing.best_fit(counts, capacity)
    content, filled = defaultdict(list), defaultdict(set)
    for k, (n, rank, first, per, offset) in enumerate(runs.tolist()):
        end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == n else counts[n]
        for j in range(end - rank):
            content[first + j // per].append(n)
            filled[first + j // per].update(range(offset + j % per * n, offset + j % per * n + n))
    assert len(content) == made and all(filled[b] == set(range(sum(x))) and sum(x) <= capacity for b, x in content.items())
    if seed < 20:
        assert Counter(sum(x) for x in content.values()) == plain_best_fit(lengths, capacity)


def test_capacity_tree():
    rnd, tree, there = random.Random(2), packing.CapacityTree(37), set()
    for _ in range(2000):
        c = rnd.randrange(1, 38)
        (there.discard if c in there else there.add)(c)
        tree.mark(c, c in there)
        need = rnd.randrange(1, 38)
        assert tree.tightest(need) == min((x for x in there if x >= need), default=None)


@pytest.mark.parametrize("bound", [0, 300_000])
def test_packing(spark, monkeypatch, bound):
    monkeypatch.setattr(packing.small, "__defaults__", (bound,))
    path, tk = tokenizer()
    rnd = random.Random(4)
    texts = TEXTS + [" ".join("abc" for _ in range(rnd.randrange(200))) for _ in range(80)] + ["x " * 63, "x " * 64, "x " * 127]
    rows = [(i, x, "s", i) for i, x in enumerate(texts)] + [(3, "again", "s", 0), (3, "again", "s", 0), (None, "none", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, offset int").repartition(5)
    packed = packing.pack(df, capacity=64).cache()
    made = [(i, (*tk.encode(x or "", add_special_tokens=False).ids, 1)) for i, x, _, _ in rows]
    want = Counter((i, k // 64, k, x[k : k + 64]) for i, x in made for k in range(0, len(x), 64))
    got = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        assert r["length"] * 4 == len(r["ids"])
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 64
    assert Counter(sum(n for _, n in b) for b in bins.values()) == plain_best_fit([r["length"] for r in got], 64)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert all(whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"]) for r in got)
    assert packing.pack(df.limit(0)).count() == 0
    packed.unpersist()
