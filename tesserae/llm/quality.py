"""Quality classifier by co-training.

Two views of a document: its text's content (hashed byte pairs and the
repetition of words) and its page metadata (source,
declared language, lengths and line layout).  Each view has a logistic classifier.  In every round
both score all documents of the pool, and each hands its most confident ones, with their predicted
labels, to the other's training set; what was handed over leaves the pool, and a document on which the
views disagree is not handed over.  In the end both are calibrated on labelled rows that took no
part in training, and their calibrated log-odds are combined.

Bounds, which are parameters: LABELLED rows of labels are fitted (chosen by a hash), and each view
hands over HANDED documents of either class a round.  All documents are scored in every round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, load, slices

LABELLED = 20_000
ROUNDS = 3
HANDED = 400
CONFIDENT = 0.9
PAIR_DIMS, META_DIMS = 512, 64
TEXT_DIMS = PAIR_DIMS + 8
THRESHOLD = 0.5


def text_view(raw: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs, and how the words repeat, as 0-255."""
    out = np.zeros(TEXT_DIMS, np.uint8)
    if len(raw) < 2:
        return out
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    pairs = (b[:-1] << 8 | b[1:]) * np.uint32(2654435761) >> np.uint32(23)
    n = np.bincount(pairs, minlength=PAIR_DIMS)
    out[:PAIR_DIMS] = np.minimum(np.sqrt(n / (len(raw) - 1)) * 512, 255)
    words = raw.split()
    if words:
        again = sum(map(eq, words, words[1:])) / len(words)
        fresh = len(set(words)) / len(words)
        size = np.log2(len(words) + 1)
        out[PAIR_DIMS:] = np.clip([again * 255, again * 1020, fresh * 255, (fresh < 0.3) * 255, size * 16, (size < 4) * 255, (size < 5) * 255, (size < 6) * 255], 0, 255)
    return out


def meta_view(source: str | None, lang: str | None, n_chars: int | None, text: str) -> np.ndarray:
    out = np.zeros(META_DIMS, np.uint8)
    out[zlib.crc32((source or "").encode()) % 24] = 255
    out[24 + zlib.crc32((lang or "").encode()) % 8] = 255
    lines = text.split("\n")
    lengths = np.array([len(x) for x in lines])
    n = len(text) if n_chars is None else max(int(n_chars), 0)
    facts = [np.log2(n + 1) * 12, np.log2(len(lines)) * 16, np.log2(lengths.mean() + 1) * 16, np.log2(lengths.max() + 1) * 12]
    facts += [255 * (lengths == 0).mean(), 255 * len(set(lines)) / len(lines), min(255, np.log2(lengths.std() + 1) * 16)]
    out[32 : 32 + len(facts)] = np.clip(facts, 0, 255)
    for at, value in ((40, facts[0]), (48, facts[2]), (56, facts[3])):  # coarse steps, so that the classifier may bend
        out[at + min(7, int(value) // 24)] = 128
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, content binary, meta binary) for every row; absent metadata columns count as null."""
    kind = docs.schema[id_col].dataType.simpleString()
    have = set(docs.columns)
    side = [F.col(c).cast(t).alias(f"m_{c}") if c in have else F.lit(None).cast(t).alias(f"m_{c}") for c, t in (("source", "string"), ("lang", "string"), ("n_chars", "long"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            content = [text_view(t.encode("utf-8", "surrogatepass")).tobytes() for t in texts]
            meta = [meta_view(s, la, n, t).tobytes() for s, la, n, t in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.binary()), pa.array(meta, pa.binary())], names=["id", "content", "meta"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *side)
    return rows.mapInArrow(run, f"id {kind}, content binary, meta binary")


def matrix(cells: list[bytes], dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, dims).astype(np.float32) / 255
    return np.hstack([x, np.ones((len(x), 1), np.float32)])


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1.0, steps: int = 12) -> np.ndarray:
    """Logistic regression by Newton's method; the last column, the intercept, is not penalised."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        s = (weight * np.maximum(p * (1 - p), 1e-6)).astype(np.float32)
        step = np.linalg.solve((x.T * s) @ x + np.diag(ridge), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class View:
    """One view's weights and its calibration: log-odds a * score + b."""

    dims: int
    w: np.ndarray
    a: float = 1.0
    b: float = 0.0

    def raw(self, cells: list[bytes]) -> np.ndarray:
        return np.clip(matrix(cells, self.dims) @ self.w, -30, 30)

    def odds(self, cells: list[bytes]) -> np.ndarray:
        return self.a * self.raw(cells) + self.b


@dataclass
class Model:
    content: View
    meta: View
    prior: float  # log-odds of the good class among the labelled
    rounds: list[list[tuple]] = field(default_factory=list)  # (view, label, id) of what was handed over in each round

    def scores(self, content: list[bytes], meta: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of either view and of both; the shared prior counts once."""
        c, m = self.content.odds(content), self.meta.odds(meta)
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return sig(c), sig(m), sig(c + m - self.prior)


def _confident(pool: DataFrame, views: tuple[View, View], handed: int) -> list[tuple]:
    """(view, label, id, content, meta) of the documents that a view is surest of, ``handed`` of each class at most.

    One scan: a task keeps the best of its rows, which are written; the best of those are taken.  Equally sure ones
    go by a hash of their features, then by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple]] = {(k, label): [] for k in (0, 1) for label in (1, 0)}
        for b in batches:
            ids, *cells = (b.column(i).to_pylist() for i in range(3))
            for k, view in enumerate(views):
                p = 1 / (1 + np.exp(-view.odds(cells[k])))
                for label, sure in ((1, p), (0, 1 - p)):
                    kept = best[k, label]
                    least = -kept[-1][0] if len(kept) == handed else CONFIDENT
                    for i in np.flatnonzero(sure >= least).tolist():
                        kept.append((-float(sure[i]), xxhash.xxh64_intdigest(cells[0][i] + cells[1][i]) >> 1, ids[i], cells[0][i], cells[1][i]))
                    kept.sort(key=lambda r: r[:3])
                    del kept[handed:]
        rows = [(k, label, *r) for (k, label), kept in best.items() for r in kept]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.float64(), pa.int64(), None, pa.binary(), pa.binary()), strict=True)]
            columns[4] = columns[4].cast(b.schema.field(0).type)
            yield pa.RecordBatch.from_arrays(columns, names=["view", "label", "cost", "tie", "id", "content", "meta"])

    kind = pool.schema["id"].dataType.simpleString()
    best = cut(pool.mapInArrow(run, f"view int, label int, cost double, tie long, id {kind}, content binary, meta binary"))
    out = []
    for k in (0, 1):
        for label in (0, 1):
            rows = best.where((F.col("view") == k) & (F.col("label") == label))
            out += [(k, label, r["id"], bytes(r["content"]), bytes(r["meta"])) for r in rows.orderBy("cost", "tie", "id").limit(handed).collect()]
    return out


def agreed(found: list[tuple]) -> list[tuple]:
    """What is handed over: each document once from a view, and none on which the views disagree; those stay in the pool."""
    labels: dict = {}
    for _, label, i, *_ in found:
        labels.setdefault(i, set()).add(label)
    first = {(f[0], f[2]): f for f in reversed(found)}
    return [f for f in found if len(labels[f[2]]) == 1 and first[f[0], f[2]] is f]


def train(table: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", limit: int = LABELLED, rounds: int = ROUNDS, handed: int = HANDED) -> Model:
    """A model from the feature table and the labels.  Labels of one class or none give a constant model."""
    good = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    good = good.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y"))
    good = good.groupBy("id").agg(F.max("y").alias("y"), F.min("y").alias("z")).where("y = z").select("id", "y")
    chosen = cut(good.orderBy(F.xxhash64("id"), "id").limit(limit))
    rows = table.join(F.broadcast(chosen), "id")  # at most ``limit`` ids
    rows = rows.groupBy("id").agg(F.min(F.struct("content", "meta", "y")).alias("r")).orderBy(F.xxhash64("id"), "id").select("r.*").collect()
    y = np.array([r["y"] for r in rows], np.float64)
    mean = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(mean / (1 - mean)))
    if len(set(y)) < 2:
        flat = lambda d: View(d, np.zeros(d + 1), 0.0, prior)
        return Model(flat(TEXT_DIMS), flat(META_DIMS), prior)
    held = np.arange(len(y)) % 5 == 4
    cells = [[bytes(r["content"]) for r in rows], [bytes(r["meta"]) for r in rows]]
    sets = [[matrix(cells[k], d)[~held], y[~held]] for k, d in enumerate((TEXT_DIMS, META_DIMS))]
    views = tuple(View(d, fit(*s)) for s, d in zip(sets, (TEXT_DIMS, META_DIMS), strict=True))
    history: list[list[tuple]] = []
    kind = table.schema["id"].dataType.simpleString()
    gone = chosen.select("id")  # at most ``limit`` ids, and what the rounds hand over
    for _ in range(rounds):
        pool = table.where("id is not null").join(F.broadcast(gone), "id", "left_anti")
        found = agreed(_confident(pool, views, handed))
        if not found:
            break
        history.append([f[:3] for f in found])
        gone = gone.unionByName(table.sparkSession.createDataFrame([(i,) for i in {f[2] for f in found}], f"id {kind}"))
        for k, d in enumerate((TEXT_DIMS, META_DIMS)):
            mine = [f for f in found if f[0] != k]  # from the other view
            if mine:
                sets[k][0] = np.vstack([sets[k][0], matrix([f[3 + k] for f in mine], d)])
                sets[k][1] = np.concatenate([sets[k][1], [f[1] for f in mine]])
        views = tuple(View(d, fit(*s)) for s, d in zip(sets, (TEXT_DIMS, META_DIMS), strict=True))
    for k, view in enumerate(views):
        part = [c for c, h in zip(cells[k], held, strict=True) if h]
        if len(set(y[held])) == 2:
            raw = view.raw(part)
            a, b = fit(np.stack([raw, np.ones(len(raw))], 1), y[held], penalty=1e-3)
            view.a, view.b = (float(a), float(b)) if a > 0 else (0.0, prior)
    return Model(*views, prior, history)


def score(table: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(id, text_score, meta_score, score, keep) for every row of the feature table."""
    kind = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = model.scores(b.column(1).to_pylist(), b.column(2).to_pylist())
            cols = [pa.array(np.round(m, 6)) for m in made]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(made[2] >= threshold)], names=["id", "text_score", "meta_score", "score", "keep"])

    return table.mapInArrow(run, f"id {kind}, text_score double, meta_score double, score double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every document with the calibrated score of either view and of both, and whether it is kept.

    Null and empty texts are scored by what is left of their views; null ids are scored but never
    labelled; repeated rows get equal scores; ids with conflicting labels are not fitted.
    """
    table = cut(features(docs, id_col, text_col))
    return score(table, train(table, labels, id_col=id_col, **options)).withColumnRenamed("id", id_col)


def op1_cotraining_quality(spark, sf_dir: str) -> DataFrame:
    """Quality scores of every row of ``documents`` from the ``quality`` labels; nulls, ties and repeated rows as in classify()."""
    return classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
