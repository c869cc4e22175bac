"""Compression of vectors to codes, one byte for each of four parts, by integer codebooks.

The nearest codebook entry of a part is found without computing most distances.  A part's components are cut into
blocks; with m the block means and r the norm of what the means leave over, the squared distance of two parts is at
least the sum of (m - m')^2 by the blocks' widths, plus (r - r')^2.  One block gives a coarse bound, four a finer one.
Entries whose coarse bound exceeds the exact distance of the most promising entry are filtered, the finer bound filters
what is left, and the survivors get exact integer distances.  Bounds are lowered by more than their rounding errors, so
no nearest entry is lost, nor any that ties with it.

Each round is a scan in which a task sums its parts by entry; the driver holds the codebooks and the sums of their
components, whose size depends on the vectors' width alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load, small, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LEVELS = (1, 4)  # blocks of a part, coarse to fine
ROWS = 2048  # vectors at a time
SAFE = 1 << 27  # components up to this have squared distances within 64 bits (parts of up to 128 components)


def whole_numbers(column: pa.Array, width: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vector is not null and holds finite numbers only, and those vectors as whole numbers.

    Shorter vectors are filled with zeros on the right.  Numbers too large for 64-bit arithmetic make an array of Python's.
    """
    column = column.cast(pa.large_list(pa.float64()))
    flat = column.flatten()  # without the null lists
    null, sizes = column.is_null().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    sizes[null] = 0
    values = flat.to_numpy(zero_copy_only=False)  # a null component becomes a NaN
    row = np.repeat(np.arange(len(column)), sizes)
    bad = null.copy()
    bad[row[~np.isfinite(values)]] = True
    keep = np.flatnonzero(~bad)
    chosen = ~bad[row]
    scaled = np.floor(values[chosen] * scale)
    large = len(scaled) and np.abs(scaled).max() > SAFE
    out = np.zeros((len(keep), width), object if large else np.int64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    slot = np.cumsum(~bad) - 1
    out[slot[row[chosen]], place[chosen]] = [int(x) for x in scaled] if large else scaled.astype(np.int64)
    return keep, out


def _summary(parts: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block means, the blocks' widths and the norm of what the means leave over, in doubles."""
    x = parts.astype(np.float64)
    cuts = np.linspace(0, x.shape[1], min(blocks, x.shape[1]) + 1).astype(int)
    width = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / width
    rest = x - np.repeat(mean, width, axis=1)
    return mean, width.astype(np.float64), np.sqrt(np.square(rest).sum(axis=1))


class Codebook:
    """The entries of one part with their summaries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.levels = [_summary(entries, b) for b in LEVELS]
        self.size = np.square(entries.astype(np.float64)).sum(axis=1)

    def nearest(self, parts: np.ndarray, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, the lower index in a tie, and the exact squared distance.

        ``seen`` gets the pairs that were left after each filter.
        """
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        exact = lambda i, e: np.square(parts[i] - self.entries[e]).sum(axis=1)
        every = np.arange(len(parts))
        slack = 1e-9 * (np.square(parts.astype(np.float64)).sum(axis=1)[:, None] + self.size.max()) + 1  # over any rounding error here
        mean, width, rest = _summary(parts, LEVELS[0])
        means, _, rests = self.levels[0]
        bound = np.square(rest[:, None] - rests)
        for k, w in enumerate(width):
            bound += w * np.square(mean[:, k, None] - means[:, k])
        best = exact(every, bound.argmin(axis=1))
        i, e = np.nonzero(bound <= best[:, None].astype(np.float64) + slack)
        left = [len(i)]
        for blocks, (means, _, rests) in zip(LEVELS[1:], self.levels[1:], strict=True):
            mean, width, rest = _summary(parts, blocks)
            fine = np.square(rest[i] - rests[e])
            for k, w in enumerate(width):
                fine += w * np.square(mean[i, k] - means[e, k])
            firsts = np.searchsorted(i, every)
            low = np.minimum.reduceat(fine, firsts)  # each part has a pair
            pick = np.flatnonzero(fine == low[i])
            pick = pick[np.unique(i[pick], return_index=True)[1]]  # the most promising entry by the finer bound
            best = np.minimum(best, exact(every, e[pick]))
            near = fine <= best.astype(np.float64)[i] + slack[i, 0]
            i, e = i[near], e[near]
            left.append(len(i))
        distance = exact(i, e)
        firsts = np.searchsorted(i, every)
        low = np.minimum.reduceat(distance, firsts)
        tied = np.flatnonzero(distance == low[i])
        first = tied[np.unique(i[tied], return_index=True)[1]]  # entries ascend within a part
        if seen is not None:
            seen[:] = [a + b for a, b in zip(seen or [0] * len(left), left, strict=True)]
        return e[first], low


def _cut(vectors: np.ndarray) -> list[np.ndarray]:
    return np.split(vectors, PARTS, axis=1)


def _vectors(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            keep, vectors = whole_numbers(part.column(column), width)
            if len(keep):
                yield part, keep, vectors


def _sums(rows: DataFrame, books: list[np.ndarray], width: int) -> dict[int, int]:
    """Sums of the components of the parts by entry, and, beyond them, the number of parts: by slot."""
    wide, n = width // PARTS, len(books[0])
    decimal = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = [Codebook(b) for b in books]
        total = np.zeros((PARTS, n, wide + 1), object)
        for _, _, vectors in _vectors(batches, 0, width):
            for p, part in enumerate(_cut(vectors)):
                code, _ = coded[p].nearest(part)
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                total[p, used, :wide] += np.add.reduceat(part[order], first, axis=0)
                total[p, used, wide] += np.diff([*first, len(code)])
        flat = total.reshape(-1)
        seen = np.flatnonzero(total[:, :, wide:].repeat(wide + 1, axis=2).reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array([int(x) for x in flat[seen]], decimal)], names=["slot", "n"])

    found = rows.mapInArrow(run, "slot int, n decimal(38,0)").groupBy("slot").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    return {r["slot"]: int(r["n"]) for r in found.collect()}


def codebooks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of the four parts, as whole numbers.

    They start as the parts of the ``entries`` vectors of smallest ids (nulls last, equal ids by their vectors), fewer
    where there are fewer; each round replaces an entry by its parts' mean, rounded down, and leaves unused ones.
    The width is that of the longest kept vector, up to a multiple of four.
    """
    whole = F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(whole).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    width = kept.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return [np.zeros((0, 0), np.int64)] * PARTS
    width = max(PARTS, -(-width // PARTS) * PARTS)
    start = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    _, first = whole_numbers(start.column("v").combine_chunks(), width)
    books, rows = _cut(first), vectors.select(F.col(vector_col).alias("v"))
    for _ in range(rounds):
        total, wide = _sums(rows, books, width), width // PARTS
        made = [b.astype(object) for b in books]
        for p in range(PARTS):
            for e in range(len(first)):
                at = (p * len(first) + e) * (wide + 1)
                if total.get(at + wide):
                    made[p][e] = [total[at + k] // total[at + wide] for k in range(wide)]
        books = [b if any(abs(int(x)) > SAFE for x in b.reshape(-1)) else b.astype(np.int64) for b in made]
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], keep: list[str], vector_col: str = "embedding") -> DataFrame:
    """The columns ``keep`` of the rows with a vector to encode, with ``code`` (two hex digits a part) and ``error``.

    An error that doesn't fit into 64 bits is null.
    """
    width = PARTS * books[0].shape[1]
    names = {c: f"k{i}" for i, c in enumerate(keep)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = [Codebook(b) for b in books]
        for b, kept, whole in _vectors(batches, len(keep), width):
            found = [coded[p].nearest(part) for p, part in enumerate(_cut(whole))]
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error = [int(x) for x in sum(d for _, d in found)]
            rows = pa.array(kept)
            cols = [b.column(i).take(rows) for i in range(len(keep))]
            cols += [pa.array([c.tobytes().hex() for c in code]), pa.array([x if x < 1 << 63 else None for x in error], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names.values(), "code", "error"])

    given = vectors.select(*[F.col(c).alias(a) for c, a in names.items()], F.col(vector_col).alias("v"))
    if not len(books[0]):
        given = given.limit(0)
    schema = given.drop("v").schema.add("code", "string").add("error", "long")
    return given.mapInArrow(run, schema).withColumnsRenamed({a: c for c, a in names.items()})


def decode(codes: DataFrame, books: list[np.ndarray], code_col: str = "code", out: str = "vector", scale: int = SCALE) -> DataFrame:
    """``codes`` with the approximate vector that each code stands for; null for a null code."""
    kind = "array<double>"
    lists = [b.astype(np.float64) / scale for b in books]

    @F.pandas_udf(kind)
    def look_up(code):
        made = lambda c: np.concatenate([lists[p][int(c[2 * p : 2 * p + 2], 16)] for p in range(PARTS)]).tolist()
        return code.map(made, na_action="ignore")

    return codes.withColumn(out, look_up(code_col))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error, label_error) of every row with a vector to encode, and the codebooks.

    Vectors that are null or hold a null, a NaN or an infinity are dropped.  Shorter vectors count as filled up with
    zeros.  Repeated rows are coded as often as they stand and weigh as much.  ``label_error`` sums the errors of equal
    labels, null ones together; it is null where one of them or the sum doesn't fit into 64 bits.  Without any vector the result is empty.
    """
    books = codebooks(vectors, id_col, vector_col, entries, rounds)
    coded = written(encode(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")), books, ["id", "label"], "v"), "codes")
    by_label = small(coded.groupBy(F.col("label").alias("__label")).agg(F.expr("if(count(*) = count(error), try_sum(error), null)").alias("label_error")))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
    return out.withColumnsRenamed({"id": id_col, "label": label_col}), books


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """The codes of all ``embeddings``; nulls, ties and repeated rows as in compress()."""
    out, books = compress(load(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """Each round as two tables: the parts' entries and the next codebook."""
    near = "arg_min(struct_pack(e := b.e, d := {0}), struct_pack(d := {0}, e := b.e))".format("list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))")
    steps = [
        "whole as (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "parts as (select vec_id, label, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) as v from whole, range(4) r(p))",
        "b0 as (select p, dense_rank() over (order by vec_id) - 1 as e, v from parts where vec_id in (select vec_id from whole order by vec_id limit 256))",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} as (select x.vec_id, x.label, x.p, any_value(x.v) as v, {near} as m from parts x join b{k} b on b.p = x.p group by x.vec_id, x.label, x.p)")
        if k < ROUNDS:
            steps.append(f"s{k} as (select p, e, list(y order by i) as v from (select p, e, i, floor(sum(c)::double / count(*))::bigint as y from (select p, m.e as e, unnest(v) as c, generate_subscripts(v, 1) as i from a{k}) group by p, e, i) group by p, e)")
            steps.append(f"b{k + 1} as (select b.p, b.e, coalesce(s.v, b.v) as v from b{k} b left join s{k} s on s.p = b.p and s.e = b.e)")
    steps.append(f"coded as (select vec_id, label, string_agg(printf('%02x', m.e), '' order by p) as code, sum(m.d)::bigint as error from a{ROUNDS} group by vec_id, label)")
    steps.append(f"books as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as digest from b{ROUNDS})")
    return f"with {', '.join(f'{s.partition(" as ")[0]} as materialized {s.partition(" as ")[2]}' for s in steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, digest as codebooks_sha256 from coded, books"


ORACLE = _oracle()
