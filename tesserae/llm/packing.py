"""Best-fit-decreasing packing of token sequences, with a segment tree over remaining capacities.

Pieces of equal length are alike to a packer, so the packing is planned from their counts by length, of which there
are at most as many as tokens in a sequence: longest first, each length goes to the tightest open bins that hold it,
found in a segment tree whose leaves are the remaining capacities.  A bin that is the tightest one stays so until the
length no longer fits, so a run of equal pieces and a run of equal bins are dealt with in one step, and the plan is the
one that best-fit decreasing makes piece by piece over the whole corpus.

The plan is a list of runs (length, first rank, first bin, pieces a bin, offset).  Each piece finds its place in it by
its length and its rank among the pieces of that length: its place within the task that cut it, and the number of such
pieces in earlier tasks.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, load, small, written

CAPACITY = 4096
END = 1
MODEL = "word_bpe_49k.json"
CACHE = 400_000  # chunks and words in each of the two generations that a worker keeps (some 90 MB each)
WINDOW = 1 << 18  # characters that are encoded at a time
RESULT = 1 << 23  # bytes of ids that a worker hands on at a time

_PLAIN = re.compile(r"[!-~]+")
#: How the tokenizer splits printable ASCII (fixed values: its own pattern, whose letters and digits are these here).
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_STOPS = re.compile(r"(?<=[a-z0-9])([.,;:!?])(?=[ \n])")


class ChunkEncoder:
    """Ids of texts, by way of the ids of the chunks between spaces and line feeds, which are kept.

    No token crosses white space, the tokenizer makes letters small, and a stop after a letter is a word of its own; so
    A-Z become small and such stops get a space before the text is split.  New chunks of printable ASCII are cut into
    the tokenizer's own words, which go to its model; other new chunks are encoded as one text, as one call costs as
    much as several words.  Texts that hold the opening of a special token are encoded as they are.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.model = self.tokenizer.model
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word of printable ASCII in small letters, by the model alone: nothing of it is there to normalise."""
        ids = self.young.get(word) or self.old.get(word)
        if ids is None:
            tokens = [t.id for t in self.model.tokenize(word)]
            ids = self.young[word] = struct.pack(f"<{len(tokens)}I", *tokens)
        return ids

    def _units(self, units: list[str]) -> dict[str, bytes]:
        """The ids of units without white space, encoded as one text."""
        if not units:
            return {}
        starts = np.cumsum([0, *(len(u) + 1 for u in units)])
        made = self.tokenizer.encode(" ".join(units), add_special_tokens=False)
        ids = np.array(made.ids, "<u4")
        cuts = np.searchsorted(np.fromiter((o[0] for o in made.offsets), np.int64, len(ids)), starts) * 4
        raw = ids.tobytes()
        return {u: raw[a:b] for u, a, b in zip(units, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}

    def _new_chunks(self, new: set[str]) -> dict[str, bytes]:
        out, units = {}, []
        for c in new:
            if c in self.old:
                out[c] = self.old[c]
            elif _PLAIN.fullmatch(c):
                words = _WORDS.findall(c)
                out[c] = self._word(c) if len(words) == 1 else b"".join(map(self._word, words))
            elif c.isprintable():  # so no white space is in it
                units.append(c)
            else:
                out[c] = self._direct(c)
        out.update(self._units(units))
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return self._direct(text)
        made, at = [], 0
        while at < len(text):
            to = len(text) if len(text) - at <= WINDOW else text.find(" ", at + WINDOW)
            to = to if to >= 0 else len(text)
            part = text[at:to]
            part = part.lower() if part.isascii() else part.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            chunks = _STOPS.sub(r" \1", part).replace("\n", " ").split(" ")
            ids = list(map(self.young.get, chunks))
            if None in ids:
                found = self._new_chunks({c for c, v in zip(chunks, ids, strict=True) if v is None and c}) | {"": b""}
                ids = [found[c] if v is None else v for c, v in zip(chunks, ids, strict=True)]
                self.young.update(found)
                if len(self.young) > self.cache:  # a full generation becomes the older one
                    self.young, self.old = {}, self.young
            made.append(b"".join(ids))
            at = to
        return b"".join(made)


_ENCODERS: dict[str, ChunkEncoder] = {}  # of this worker, which serves several tasks


def cut_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids, task, nth): each row's ids and the end id, cut every ``capacity`` tokens; a table.

    ``ids`` are little-endian unsigned 32-bit numbers, ``nth`` counts the pieces of one length that the task has cut
    before.  Null and empty texts are the end id alone.  The tokenizer's file must be at the same path wherever tasks run.
    """
    import public_tokenizers

    path, kind = path or public_tokenizers.path(MODEL), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(path)
        encoder, task, seen, tail = _ENCODERS[path], TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), np.array([end], "<u4").tobytes()
        for b in batches:
            rows, size = [], 0
            for i in range(b.num_rows):
                raw = encoder.encode(b.column(1)[i].as_py() or "") + tail
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[at : at + 4 * capacity]
                    n = len(ids) // 4
                    rows.append((i, k, k * capacity, n, ids, int(seen[n])))
                    seen[n] += 1
                    size += len(ids)
                    if size > RESULT:
                        yield _batch(b, rows, task)
                        rows, size = [], 0
            if rows:
                yield _batch(b, rows, task)
            del b
        pa.default_memory_pool().release_unused()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return written(given.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary, task int, nth long"), "pieces")


def _batch(b: pa.RecordBatch, rows: list[tuple], task: int) -> pa.RecordBatch:
    at, piece, start, length, ids, nth = zip(*rows, strict=True)
    cols = [b.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays([*cols, pa.array([task] * len(at), pa.int32()), pa.array(nth, pa.int64())], names=["id", "piece", "start", "length", "ids", "task", "nth"])


class CapacityTree:
    """A segment tree over remaining capacities; a node says whether a bin is open anywhere below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        at = self.size + capacity
        self.open[at] = is_open
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of an open bin that is at least ``need``."""
        at = self.size + need
        if self.open[at]:
            return need
        while at > 1 and not (at & 1 == 0 and self.open[at + 1]):  # up to a node with an open right neighbour
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over ``counts`` pieces of each length: the runs, and how many bins there are.

    A run is (length, first rank, first bin, pieces a bin, offset in the bin); it ends where the next of its length starts.
    """
    tree, bins, runs, made = CapacityTree(capacity), defaultdict(deque), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no sequence holds {length} tokens")
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # as many new bins as the rest of this length fills
                room, n = capacity, -(-left // (capacity // length))
                bins[room].append((made, n))
                tree.mark(room, True)
                made += n
            first, n = bins[room].popleft()
            per = min(left, room // length)
            used = min(n, left // per)
            if used < n:
                bins[room].appendleft((first + used, n - used))
            if not bins[room]:
                tree.mark(room, False)
            runs.append((length, rank, first, per, capacity - room))
            rank, left, room = rank + used * per, left - used * per, room - per * length
            if room:
                bins[room].append((first, used))
                tree.mark(room, True)
    return np.array(runs, np.int64).reshape(-1, 5), made


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a table with length, task and nth) with ``sequence_id`` and ``offset`` in place of task and nth.

    The driver holds a count for each length and the runs; a window holds the tasks that cut pieces of one length.
    """
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    before = small(counts.withColumn("before", F.coalesce(earlier, F.lit(0))))
    totals = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_fit(totals, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    keys = runs[:, 0] << 48 | runs[:, 1]
    names = [c for c in pieces.columns if c not in ("task", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(len(names)).to_numpy(), b.column(len(names) + 1).to_numpy()
            at = np.searchsorted(keys, length << 48 | rank, "right") - 1
            within, per = rank - runs[at, 1], runs[at, 3]
            cols = [b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(runs[at, 2] + within // per), pa.array(runs[at, 4] + within % per * length)], names=[*names, "sequence_id", "offset"])

    ranked = pieces.join(before.select("length", "task", "before"), ["length", "task"])
    ranked = ranked.select(*names, F.col("length").alias("__length"), (F.col("before") + F.col("nth")).alias("__rank"))
    return ranked.mapInArrow(run, pieces.select(*names).schema.add("sequence_id", "long").add("offset", "long"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset): every piece of ``docs`` with its ids and its place.

    Every row is packed, repeated ones and those with a null id too; null and empty texts are one token long.  Columns
    other than the two named are not read.  An empty table gives an empty result.
    """
    return place(cut_pieces(docs, path, capacity, end, id_col, text_col), capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence's pieces end to end, as numbers of 32 bits; a group has one sequence's pieces."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.expr("aggregate(parts, X'', (all, p) -> concat(all, p.ids))").alias("ids"))


def op13_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all ``documents`` and their places in sequences of 4096 tokens; nulls and repeated rows as in pack()."""
    pieces = cut_pieces(load(spark, sf_dir, "documents"))
    out = place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
