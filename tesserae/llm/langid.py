"""Language identification by hyperdimensional profiles.

Each letter has a random +-1 vector.  An n-gram is the product of its letters' vectors, each
permuted (rolled) by its distance from the n-gram's end; a text is the sum over its n-grams, and a
language is the sum over its training texts.  A document gets the language of highest cosine.

Binding and bundling are linear, so training first sums n-gram counts by language and n-gram (partial sums a task, then a
shuffle), and each different n-gram of a language is bound once.  The sums of the bound vectors are the prototypes: a
language costs the driver as many numbers as a vector has dimensions, however many texts it has.

Every letter of every script has a vector of its own, made from a seeded hash of its small form's code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded

DIMENSIONS = 1024
SEED = 20240
CACHE = 20_000  # n-gram vectors that a worker keeps (80 MB at 1024 dimensions)
PENDING = 1 << 20  # n-grams that a training task holds before it merges them
PART = 8192  # n-grams that are bound or looked up at a time
HELD = 16  # languages whose sums a training task holds at once
UNKNOWN = "und"
_CODE = (1 << 21) - 1  # a code point has 21 bits


def _symbol(c: str) -> int:
    """The code point of a letter's small form (its first, if there are several); 0 for whatever is no letter."""
    return ord(c.lower()[0]) if c.isalpha() else 0


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    return np.array([_symbol(chr(cp)) for cp in range(0x10000)], np.int64)


def ngrams(text: str | None) -> np.ndarray:
    """Ids of the text's letter trigrams, three code points each; runs of other characters count as one boundary."""
    if not text:
        return np.zeros(0, np.int64)
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if cps.max() < 0x10000:
        sym = _symbol_table()[cps]
    else:
        sym = _symbol_table()[np.minimum(cps, 0xFFFF)]
        for cp in np.unique(cps[cps >= 0x10000]):
            sym[cps == cp] = _symbol(chr(cp))
    if not sym.any():
        return np.zeros(0, np.int64)
    sym = np.concatenate([[0], sym, [0]])
    sym = sym[(sym > 0) | (np.concatenate([[1], sym[:-1]]) > 0)]
    return (sym[:-2] << 42 | sym[1:-1] << 21 | sym[2:]) if len(sym) > 2 else np.zeros(0, np.int64)


def letters(codes: np.ndarray, dims: int) -> np.ndarray:
    """The +-1 vectors of letters, a row for each code point: the bits of a seeded 64-bit mix (splitmix64) of it and a counter."""
    words = -(-dims // 64)
    x = (codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)) + np.uint64(SEED) * np.uint64(1 << 32)
    x = x * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(codes), -1), axis=1)[:, :dims]
    return bits.astype(np.float32) * 2 - 1


def bind(ids: np.ndarray, dims: int) -> np.ndarray:
    """The vectors of n-gram ids, one a row."""
    codes, at = np.unique(np.concatenate([ids >> 42, ids >> 21 & _CODE, ids & _CODE]), return_inverse=True)
    table, n = letters(codes, dims), len(ids)
    first, second = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
    return first[at[:n]] * second[at[n : 2 * n]] * table[at[2 * n :]]


class Profiles:
    """Language prototypes of unit length and the scoring of texts against them."""

    def __init__(self, names: list[str], vectors: np.ndarray, dims: int = DIMENSIONS):
        self.names, self.vectors, self.dims = names, vectors, dims
        self._keys = self._slots = self._rows = None

    def __getstate__(self):
        return {"names": self.names, "vectors": self.vectors, "dims": self.dims, "_keys": None, "_slots": None, "_rows": None}

    def _bound(self, ids: np.ndarray) -> np.ndarray:
        """The vectors of different ids in ascending order; those that the worker has not kept are bound."""
        if self._keys is None:
            self._keys, self._slots, self._rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.empty((CACHE, self.dims), np.float32)
        at = np.searchsorted(self._keys, ids)
        new = ids[self._keys[np.minimum(at, len(self._keys) - 1)] != ids] if len(self._keys) else ids
        if len(self._keys) + len(new) > CACHE:
            self._keys, self._slots, new = self._keys[:0], self._slots[:0], ids
            if len(ids) > CACHE:
                return bind(ids, self.dims)
        if len(new):
            used = len(self._keys)
            self._rows[used : used + len(new)] = bind(new, self.dims)
            at = np.searchsorted(self._keys, new)
            self._slots = np.insert(self._slots, at, np.arange(used, used + len(new)))
            self._keys = np.insert(self._keys, at, new)
        return self._rows[self._slots[np.searchsorted(self._keys, ids)]]

    def predict(self, text: str | None) -> tuple[str, float]:
        ids = ngrams(text)
        if not len(ids) or not self.names:
            return UNKNOWN, 0.0
        ids, n = np.unique(ids, return_counts=True)
        v = np.zeros(self.dims, np.float32)
        for k in range(0, len(ids), PART):  # texts of very many different n-grams go in parts
            v += n[k : k + PART].astype(np.float32) @ self._bound(ids[k : k + PART])
        size = float(np.sqrt(np.square(v, dtype=np.float64).sum()))
        if not size:
            return self.names[0], 0.0
        cos = self.vectors @ v / size
        best = int(np.argmax(cos))
        return self.names[best], round(float(min(max(cos[best], 0.0), 1.0)), 6)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMENSIONS) -> Profiles:
    """Profiles from all rows with a language and a text.

    A task merges the n-grams of its rows when it holds PENDING of them.  The sums are whole numbers, so the result
    doesn't depend on the order of rows.  The driver and each worker hold one vector a language (8 KB and 4 KB at 1024
    dimensions), so ``lang_col`` must name languages, not rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, found, held = {}, [], 0

        def merged() -> Iterator[pa.RecordBatch]:
            where, ids = np.concatenate([np.full(len(i), k) for k, i in found]), np.concatenate([i for _, i in found])
            listed = list(names)
            for k in np.unique(where).tolist():
                own, n = np.unique(ids[where == k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([listed[k]] * len(own), pa.string()), pa.array(own), pa.array(n)], names=["lang", "id", "n"])

        for b in bounded(batches, 1):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = ngrams(text.as_py())
                if len(ids):
                    found.append((names.setdefault(lang, len(names)), ids))
                    held += len(ids)
                if held > PENDING:
                    yield from merged()
                    names, found, held = {}, [], 0
        if held:
            yield from merged()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, v in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * dims, pa.string()), pa.array(np.arange(dims)), pa.array(v.astype(np.int64))], names=["lang", "dim", "n"])
            total.clear()

        for b in batches:
            for at in range(0, b.num_rows, PART):
                part = b.slice(at, PART)
                names, ids, n = part.column(0).dictionary_encode(), part.column(1).to_numpy(), part.column(2).to_numpy().astype(np.float64)
                vectors, where = bind(ids, dims), names.indices.to_numpy()
                for k, lang in enumerate(names.dictionary.to_pylist()):
                    if lang not in total and len(total) == HELD:
                        yield from flush()
                    total[lang] = total.get(lang, 0) + n[where == k] @ vectors[where == k].astype(np.float64)
        yield from flush()

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(count, "lang string, id long, n long").groupBy("lang", "id").agg(F.sum("n").alias("n"))
    sums = counts.mapInArrow(bundle, "lang string, dim long, n long").groupBy("lang", "dim").agg(F.sum("n").alias("n"))
    table = sums.toArrow().to_pandas()  # as many rows a language as dimensions
    names, vectors = [], []
    for lang, part in sorted(table.groupby("lang"), key=lambda x: x[0]):
        v = np.zeros(dims)
        v[part["dim"].to_numpy()] = part["n"].to_numpy(np.float64)
        names.append(lang)
        vectors.append(v / (np.linalg.norm(v) or 1))
    return Profiles(names, np.array(vectors, np.float32).reshape(len(names), dims), dims)


def identify(docs: DataFrame, profiles: Profiles, keep: list[str] | None = None, text_col: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` (the columns ``keep``, all by default) with the predicted language and its cosine.

    A text that is null or has no letter gets ``und`` and 0; so does every text if no language was
    learned.  Ties go to the name that sorts first.  A cosine below 0 counts as 0.  Input columns named
    like the two new ones are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in (out.lower(), score.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, place):
            made = [profiles.predict(t.as_py()) for t in b.column(place)]
            cols = [b.column(i) for i in range(len(keep))]
            cols += [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, out, score])

    schema = docs.select(*keep).schema.add(out, "string").add(score, "double")
    given = docs.select(*keep) if text_col in keep else docs.select(*keep, F.col(text_col).alias("__text"))
    place = keep.index(text_col) if text_col in keep else len(keep)  # the text travels once
    return given.mapInArrow(run, schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every row of ``documents``, learned from the rows that are not held out; nulls and ties as in identify()."""
    from .common import load

    docs = load(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    profiles = train(docs.where(~held))
    out = identify(docs.select("doc_id", "text"), profiles, keep=["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
