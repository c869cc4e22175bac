"""SimHash fingerprints and near-duplicate groups by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  Two fingerprints that differ in at most two
bits have a segment in which they differ in at most one bit, so both emit an equal key among

* the segment itself (no bit of it differs), and
* the segment with one bit blanked, for each of its 32 bits (that bit differs).

Rows with an equal key are joined and the full distance is verified.  For corpora beyond some 10^8
different fingerprints, ``segments=3`` takes the pairs of three segments instead: some pair of them
differs in at most one bit too, and its 42 and more bits keep chance agreement rare, for twice the keys.

A key that many different fingerprints share is not expanded into pairs: there the remaining bits
are indexed by their own one- and two-bit deletion variants, whose equality already proves the
distance (see ``_dense``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, slices
from .components import connected_components

SEED = 42
DENSE = 128  # keys shared by more fingerprints than this take the pair-free path


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned fingerprint of one text (0 where it has no words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [b"%b %b %b" % t for t in zip(words, words[1:], words[2:], strict=False)]
    else:
        grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    digest = xxhash.xxh64_digest
    total, n = np.zeros(64, np.int64), len(grams)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        raw = b"".join([digest(g, SEED) for g in grams[at : at + 65536]])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp bigint) for every row.  Null and empty texts have fingerprint 0; other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed)], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _masks(segments: int) -> list[list[int]]:
    """The bits of each table's key: one of two segments, or two of three."""
    if segments == 2:
        return [list(range(32)), list(range(32, 64))]
    if segments == 3:
        cuts = [list(range(21)), list(range(21, 42)), list(range(42, 64))]
        return [cuts[0] + cuts[1], cuts[0] + cuts[2], cuts[1] + cuts[2]]
    raise ValueError("two or three segments serve a bound of two bits")


def _signed(bits: list[int]) -> int:
    v = sum(1 << b for b in bits)
    return v - (1 << 64) if v >> 63 else v


def segment_keys(fps: DataFrame, segments: int = 2, spread: int | None = None) -> DataFrame:
    """(place, key, fp, slot) for every table's key and its one-wildcard variants; slot is 65 * table + blanked bit (64: none).

    A key's bits are cut into quarters.  All variants that blank a bit of one quarter agree in the other three, whose
    hash is the place, so a fingerprint is shuffled by its places, four a table, and makes its variants where it arrives:
    equal keys are in one partition already.
    """
    quarters, cases = [], []
    for t, bits in enumerate(_masks(segments)):
        for q in range(4):
            own = bits[q::4]
            at = 4 * t + q
            quarters.append(f"struct(cast({at} as tinyint) as quarter, xxhash64({at}, fp & {_signed([b for b in bits if b not in own])}L) as place)")
            made = []
            for blank in [*own, *([None] if q == 0 else [])]:
                mask = _signed([b for b in bits if b != blank])
                slot = 65 * t + (64 if blank is None else blank)
                made.append(f"struct(cast({slot} as smallint) as slot, fp & {mask}L as part)")
            cases.append(f"when quarter = {at} then array({', '.join(made)})")
    laid = fps.select("fp", F.expr(f"inline(array({', '.join(quarters)}))"))
    laid = laid.repartition(spread or int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "place")
    keys = laid.select("place", "fp", F.expr(f"explode(case {' '.join(cases)} end)").alias("k"))
    return keys.select("place", F.xxhash64("k.slot", "k.part").alias("key"), "fp", F.col("k.slot").alias("slot"))


def _dense(rows: DataFrame, segments: int) -> DataFrame:
    """Edges inside keys that many fingerprints share, without forming pairs.

    The key fixes its bits, or all of them but one.  The remaining bits may then differ in two places
    (no bit blanked) or in one (the blanked bit differs).  So they are indexed by their two-bit deletion
    variants in the first case and their one-bit ones in the second: members of an equal variant are
    within the bound by construction, and one edge to the smallest of them links them all.
    """
    cases = []
    for t, bits in enumerate(_masks(segments)):
        rest = [b for b in range(64) if b not in bits]
        two = [_signed([b for b in rest if b not in (x, y)]) for n, x in enumerate(rest) for y in rest[n + 1 :]]
        one = [_signed([b for b in rest if b != x]) for x in rest]
        for test, masks in ((f"slot = {65 * t + 64}", two), (f"slot div 65 = {t} and slot <> {65 * t + 64}", one)):
            listed = ", ".join(f"{m}L" for m in masks)
            cases.append(f"when {test} then transform(array({listed}), (m, n) -> xxhash64(n, fp & m))")
    sub = rows.select("key", "fp", F.expr(f"explode(case {' '.join(cases)} end)").alias("sub"))
    low = sub.groupBy("key", "sub").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    low = low.where("low <> high")
    both = sub.join(low, ["key", "sub"]).where("fp <> low and bit_count(fp ^ low) <= 2")
    return both.select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, bits: int = 2, dense: int = DENSE, segments: int = 2) -> DataFrame:
    """Edges (a, b) between different fingerprints that connect all pairs within two differing bits.

    A pair that differs in one bit of a key is joined on that blanked bit only, not on all.
    """
    if bits != 2:
        raise ValueError("the keys serve a bound of two bits")
    keyed = segment_keys(fps, segments).withColumn("n", F.count("*").over(Window.partitionBy("place", "key")))
    keyed = cut(keyed.where("n > 1").select("key", "fp", "slot", "n"))
    few = keyed.where(F.col("n") <= dense)
    a, b = few.select("key", F.col("fp").alias("a"), "slot"), few.select("key", F.col("fp").alias("b"))
    differs = F.expr("slot % 65 = 64 or getbit(a ^ b, if(slot % 65 = 64, 0, slot % 65)) = 1")
    pairs = a.join(b, "key").where("a < b and bit_count(a ^ b) <= 2").where(differs).select("a", "b").distinct()
    return pairs.unionByName(_dense(keyed.where(F.col("n") > dense), segments))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, segments: int = 2) -> DataFrame:
    """One row per input row: (id, fingerprint hex, component_id).

    component_id is the smallest id reachable over links of at most two differing bits.  Equal
    fingerprints are one node, so exact copies cost nothing.  Null ids take part but never name a
    component unless all its ids are null; an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    edges = cut(links(nodes.select("fp"), segments=segments))
    comp = connected_components(edges)
    named = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    label = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.select("fp", "root").join(label, "root").select("fp", "component_id")
    out = prints.join(by_fp, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``; nulls, ties and repeated rows as in near_duplicates()."""
    from .common import load

    return near_duplicates(load(spark, sf_dir, "documents"))
