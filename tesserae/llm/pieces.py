"""SentencePiece encoding by N-best segmentation over the piece lattice, and decoding.

A forward Viterbi pass gives, for every place in a text, the best score of a segmentation of what
precedes it.  Those scores are exact heuristics for an A* search that walks backward from the end,
so it pops only states on one of the N best paths.

No piece of a SentencePiece model crosses from one word into the next, nor (checked when the model
is read) from Latin letters to other characters.  The lattice therefore falls into independent
parts; each different part is searched once and kept, and the N best segmentations of the whole come
from the parts with the smallest score gaps.

The scores are the model's own.  Those of a BPE model are merge ranks, so the best path over them is not the
order in which BPE merges, and its ids differ from the library's own encoding; decoding is exact either way.
"""

from __future__ import annotations

import gc
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load, slices

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # read by the driver only
NBEST = 2
CACHE = 150_000  # parts in each of the two generations that a task keeps (about 100 MB each)
LONGEST = 48  # characters of a part that is kept
ARRAY = 98_304  # characters that are searched at a time
FEW = 1024  # parts that are worth arrays of their own
WIDTHS = (4, 6, 7, 8, 9, 10, 11, 12, 14, 16, 20, 28)  # parts of similar length share arrays
BYTE_PENALTY = 10.0
LITERAL = (SPACE,)  # the part that stands for a space mark in the text itself; no string equals it
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, and the ids of the byte pieces (empty: no fallback)."""

    names: tuple[str, ...]
    scores: tuple[float, ...]
    normal: frozenset[int]
    byte_ids: tuple[int, ...]
    unk: int

    @staticmethod
    def read(path: str) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        plain = frozenset(i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)))
        byte_ids = tuple(m.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        return Vocabulary(
            tuple(m.id_to_piece(i) for i in range(n)),
            tuple(m.get_score(i) for i in range(n)),
            plain,
            byte_ids if all(m.is_byte(i) for i in byte_ids) else (),
            m.unk_id(),
        )


def packed(ids: list[int] | tuple[int, ...]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class PieceTable:
    """Pieces by a 64-bit hash, for look-ups of whole arrays."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)
    BITS = (18, 16, 14)  # three levels; a key that finds its slot taken goes one level down
    SEEN = 20  # leading bits of the hashes that are marked

    def __init__(self, pieces: dict[str, tuple[float, int]]):
        names = list(pieces)
        keys = np.array([self.hash(n) for n in names], np.uint64)
        if len(set(keys.tolist())) < len(keys):
            raise ValueError("two pieces share a hash")
        self.levels, left, all_keys = [], np.arange(len(keys)), keys
        for bits in self.BITS:
            slot = (keys[left] >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            table, index = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            table[slot[first]], index[slot[first]] = keys[left[first]], left[first]
            self.levels.append((np.uint64(64 - bits), table, index))
            left, keys = np.delete(left, first), keys * self.FACTOR
        self.rest = {n: pieces[n] for n in (names[i] for i in left)}  # none, as a rule
        self.seen = np.zeros(1 << self.SEEN, bool)
        self.seen[(all_keys >> np.uint64(64 - self.SEEN)).astype(np.int64)] = True
        self.ids = np.array([pieces[n][1] for n in names] + [-1], np.int32)

    @classmethod
    def hash(cls, name: str) -> int:
        h = 0
        for c in name:
            h = (h * 0x100000001B3 + ord(c) + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        return h

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Whether a hash can be a piece's: true for all of those and for few others."""
        return self.seen[h >> np.uint64(64 - self.SEEN)]

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash's piece, or -1."""
        out, key = None, h
        for shift, table, index in self.levels:
            slot = (h >> shift).astype(np.int64)
            at = np.where(table[slot] == h, index[slot], -1)
            out = at if out is None else np.where(out < 0, at, out)
            h = h * self.FACTOR
        return out


class Segmenter:
    def __init__(self, vocab: Vocabulary, nbest: int = NBEST, cache: int = CACHE):
        self.vocab, self.nbest, self.cache = vocab, nbest, cache
        self.pieces = {vocab.names[i]: (vocab.scores[i], i) for i in vocab.normal}
        self.longest = max(map(len, self.pieces), default=1)
        # pieces that a model marks as never to be used have a score beyond all others'
        self.low = min((s for s, _ in self.pieces.values() if s > -1e8), default=0.0) - BYTE_PENALTY
        mixed = re.compile(f"[{_LATIN}][^{_LATIN}]|[^{_LATIN}{SPACE}][{_LATIN}]")
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        if crossing:
            self.split = lambda s: [s]
        elif any(mixed.search(p) for p in self.pieces):
            self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.split = re.compile(f"{SPACE}*[{_LATIN}]+|{SPACE}*[^{_LATIN}{SPACE}]+|{SPACE}+").findall
        self.kept: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}
        self.table = PieceTable(self.pieces)
        self.sizes = [len(p) for p in self.pieces]
        spelled = [self.low * (k if vocab.byte_ids else 1) for k in (1, 2, 3, 4)]
        self.arc_scores = np.array([x for x, _ in self.pieces.values()] + spelled + [-np.inf])
        mark = SPACE.encode()
        self.raw = [n.encode("utf-8", "surrogatepass").replace(mark, b" ") for n in vocab.names]
        for byte, i in enumerate(vocab.byte_ids):
            self.raw[i] = bytes([byte])

    def _fallback(self, c: str) -> tuple[float, tuple[int, ...]]:
        raw = c.encode("utf-8", "surrogatepass")
        if self.vocab.byte_ids:
            return self.low * len(raw), tuple(self.vocab.byte_ids[b] for b in raw)
        return self.low, (self.vocab.unk,)

    def forward(self, part: str) -> tuple[list[list[tuple]], list[float]]:
        """For each end, its arcs (start, score, ids) and the best score up to it.

        A character without a piece of its own gets its bytes.
        """
        get, longest = self.pieces.get, self.longest
        arcs, best = [[]], [0.0]
        for end in range(1, len(part) + 1):
            here, top = [], -float("inf")
            for start in range(end - longest if end > longest else 0, end):
                got = get(part[start:end])
                if got:
                    score = got[0]
                    here.append((start, score, got[1]))
                    if best[start] + score > top:
                        top = best[start] + score
            if part[end - 1] not in self.pieces:
                score, ids = self._fallback(part[end - 1])
                here.append((end - 1, score, ids))
                top = max(top, best[end - 1] + score)
            arcs.append(here)
            best.append(top)
        return arcs, best

    def search(self, part: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best (score, ids) of one part, best first.

        A* from the end: a state's priority is its own score plus the forward score of what is left,
        which is exact, so the states popped lie on the paths returned.  Among equals the longer path goes first.
        """
        arcs, best = self.forward(part)
        heap, made, out = [(-best[-1], len(part), 0, 0.0, None)], 0, []
        pop, push = heapq.heappop, heapq.heappush
        while heap and len(out) < n:
            _, at, _, done, path = pop(heap)
            if not at:
                ids: list[int] = []
                while path:
                    ids.extend(path[0] if isinstance(path[0], tuple) else (path[0],))
                    path = path[1]
                out.append((done, ids))
                continue
            for start, w, ids_ in arcs[at]:
                made += 1
                g = done + w
                push(heap, (-(g + best[start]), start, made, g, (ids_, path)))
        return out

    def search_all(self, parts: list[str], n: int) -> list[tuple]:
        """The entries (see entry()) of many parts of LONGEST characters at most: search(), a step of all parts at a time in arrays."""
        out: list = [()] * len(parts)
        lengths = np.array([len(p) for p in parts])
        low = 0
        for high in (*WIDTHS, LONGEST):
            where = np.flatnonzero((lengths >= low) & (lengths <= high))
            if len(where) < FEW and high < LONGEST:
                continue  # too few for arrays of their own: they join the next longer ones
            low = high + 1
            rows = ARRAY // high
            for lo in range(0, len(where), rows):
                some = where[lo : lo + rows]
                for i, found in zip(some.tolist(), self._search_all([parts[i] for i in some], lengths[some], high, n), strict=True):
                    out[i] = found
        return out

    def _forward_all(self, own: list[str], lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Arcs (end, length - 1, part), as places in the score list or -1, and the best score up to each end."""
        n, longest, table = len(own), min(width, self.longest), self.table
        cps = np.array(own, f"<U{width}").view(np.uint32).reshape(n, width).T
        arcs = np.full((width + 1, longest, n), -1, np.int32)
        keys = cps.astype(np.uint64) + np.uint64(1)
        h = np.zeros((width, n), np.uint64)
        for size in range(1, longest + 1):  # the substrings of one length from all starts at a time
            h = (h[: width - size + 1] * np.uint64(0x100000001B3) + keys[size - 1 :]) * table.FACTOR
            if size == 1:  # a character without a piece of its own gets its bytes
                at = table.find(h.reshape(-1)).reshape(h.shape)
                spelled = len(self.pieces) + (cps >= 0x80) + (cps >= 0x800) + (cps >= 0x10000)
                arcs[1:, 0] = np.where((at < 0) & (np.arange(width)[:, None] < lengths), spelled, at)
                continue
            places = np.flatnonzero(table.maybe(h))
            at = table.find(h.reshape(-1)[places])
            places, at = places[at >= 0], at[at >= 0]
            arcs[places // n + size, size - 1, places % n] = at
        best = np.empty((width + 1, n))
        best[0] = 0
        for end in range(1, width + 1):
            m = min(end, longest)
            best[end] = (best[end - m : end][::-1] + self.arc_scores[arcs[end, :m]]).max(axis=0)
        return arcs, best

    def _search_all(self, own: list[str], lengths: np.ndarray, width: int, n: int) -> list[tuple]:
        """Each step pops the best open state of every part that still lacks paths and pushes what leads to it.

        The states that one step pushes form a block, so a state's place tells the step, and the step its parent.
        Among equals the state pushed last goes first, which is on the longer path.
        """
        arcs, best = self._forward_all(own, lengths, width)
        wide, m = arcs.shape[1], len(own)
        lens = np.arange(1, wide + 1)
        room, used = 10 * wide, 0
        open_, scored = np.empty((m, room)), np.empty((m, room))  # priorities and own scores of the states
        place, took = np.empty((m, room), np.int16), np.empty((m, room), np.int32)
        parents: list[np.ndarray] = []
        live, pos, done, state = np.arange(m), lengths.astype(np.int64), np.zeros(m), np.full(m, -1)
        found, totals, lasts = np.zeros(m, np.int64), np.zeros((m, n)), np.full((m, n), -1)
        while len(live):
            ended = np.flatnonzero(pos == 0)
            if len(ended):
                rows = live[ended]
                totals[rows, found[rows]], lasts[rows, found[rows]] = done[ended], state[ended]
                found[rows] += 1
            if used == room:
                open_, scored, place, took = (np.concatenate([x, np.empty_like(x)], axis=1) for x in (open_, scored, place, took))
                room *= 2
            a = arcs[pos, :, live]
            start = np.maximum(pos[:, None] - lens, 0)
            g = done[:, None] + self.arc_scores[a]
            f = g + best[start, live[:, None]]
            f[a < 0] = -np.inf
            f[ended] = -np.inf
            block = slice(used, used + wide)
            open_[live, block], scored[live, block], place[live, block], took[live, block] = f, g, start, a
            parent = np.full(m, -1)
            parent[live] = state
            parents.append(parent)
            used += wide
            if len(ended):
                live = live[found[live] < n]
            rows = open_[live, :used]
            state = used - 1 - rows[:, ::-1].argmax(axis=1)
            some = rows[np.arange(len(live)), state] > -np.inf
            if not some.all():
                live, state = live[some], state[some]
            open_[live, state] = -np.inf
            pos, done = place[live, state].astype(np.int64), scored[live, state]
        steps = np.stack(parents)
        at, row = lasts.reshape(-1), np.repeat(np.arange(m), n)
        seqs, counts = np.zeros((m * n, width), np.int32), np.zeros(m * n, np.int64)
        on = np.flatnonzero(at >= 0)
        while len(on):  # back to the end of the text: the pieces come in order
            here, rows = at[on], row[on]
            seqs[on, counts[on]] = took[rows, here]
            counts[on] += 1
            at[on] = steps[here // wide, rows]
            on = on[at[on] >= 0]
        raw = self.table.ids[np.minimum(seqs, len(self.pieces))].tobytes()
        size = 4 * width
        spelled = [raw[k * size : k * size + 4 * c] for k, c in enumerate(counts.tolist())]
        for k in np.flatnonzero((seqs >= len(self.pieces)).any(axis=1)).tolist():
            spelled[k] = self._spelled(own[k // n], seqs[k, : counts[k]].tolist())
        losses = totals[:, :1] - totals
        gaps = np.where(found > 1, losses[:, 1], np.inf) if n > 1 else np.full(m, np.inf)
        rests = [tuple(zip(loss[1:c], spelled[k + 1 : k + c], strict=True)) for k, c, loss in zip(range(0, m * n, n), found.tolist(), losses.tolist(), strict=True)]
        return list(zip(totals[:, 0].tolist(), spelled[::n], gaps.tolist(), rests, strict=True))

    def _spelled(self, part: str, arcs: list[int]) -> bytes:
        """The ids of a path with characters that are sent as bytes."""
        out, at = [], 0
        for a in arcs:
            if a < len(self.pieces):
                out.append(int(self.table.ids[a]))
                at += self.sizes[a]
            else:
                out.extend(self._fallback(part[at])[1])
                at += 1
        return packed(out)

    def prepare(self, texts: list[list]) -> None:
        """Searches the parts of some texts that are not kept yet, all at once."""
        if self.table.rest:
            return
        if len(self.kept) >= self.cache:
            self.before, self.kept = self.kept, {}
        kept, before, new = self.kept, self.before, set()
        for parts in texts:
            new.update(parts)
        new.difference_update(kept)
        for p in [p for p in new if p in before]:
            kept[p] = before[p]
            new.discard(p)
        new = [p for p in new if p is not LITERAL and len(p) <= LONGEST]
        kept.update(zip(new, self.search_all(new, self.nbest), strict=True))

    @staticmethod
    def entry(found: list[tuple]) -> tuple:
        """What is kept of a part: its best score and packed ids, what the next best loses, and the next ones' losses and ids."""
        (score, ids), *rest = ((s, packed(i)) for s, i in found)
        return score, ids, score - rest[0][0] if rest else float("inf"), tuple((score - s, i) for s, i in rest)

    def part(self, part: str | tuple) -> tuple:
        """The entry of one part; kept for later texts."""
        got = self.before.get(part)
        if got is None:
            found = [self._fallback(SPACE)] if part is LITERAL else self.search(part, self.nbest)
            got = self.entry(found)
        if len(part) <= LONGEST:
            if len(self.kept) >= self.cache:
                self.before, self.kept = self.kept, {}
            self.kept[part] = got
        return got

    def parts(self, text: str) -> list[str]:
        body = SPACE + text.replace(" ", SPACE) if SPACE not in text else None
        if body is not None:
            return self.split(body)
        # a literal space mark would decode to a blank: it is sent as bytes, as a part of its own
        out = self.split(SPACE + text.split(SPACE, 1)[0].replace(" ", SPACE))
        for piece in text.split(SPACE)[1:]:
            out.append(LITERAL)
            out += self.split(piece.replace(" ", SPACE)) if piece else []
        return out

    def encode(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation."""
        score, ids = self.best(text)[0]
        return ids.tolist(), score

    def best(self, text: str, parts: list | None = None) -> list[tuple[float, np.ndarray]]:
        """(score, ids) of the N best segmentations of the whole text, best first; fewer if it has fewer.

        A path among the N best changes no part outside the N - 1 of the smallest gaps, since each of
        those alone would beat it.
        """
        parts = self.parts(text) if parts is None else parts
        got = list(map(self.kept.get, parts))
        if None in got:
            got = [g or self.part(p) for g, p in zip(got, parts, strict=True)]
        spelled = list(map(itemgetter(1), got))
        raw = b"".join(spelled)
        total, sums = sum(map(itemgetter(0), got)), [(0.0, ())]
        gaps = list(map(itemgetter(2), got))
        least = [gaps.index(min(gaps))] if self.nbest == 2 else heapq.nsmallest(self.nbest - 1, range(len(gaps)), gaps.__getitem__)
        for k in least:
            grown = [(loss + less, (*changes, (k, own))) for loss, changes in sums for less, own in got[k][3]]
            sums = heapq.nsmallest(self.nbest, sums + grown, key=itemgetter(0))
        out = [(total, np.frombuffer(raw, np.int32))]
        for loss, changes in sums[1:]:
            made, at = [], 0
            for k, own in sorted(changes):
                begin = sum(map(len, spelled[:k]))
                made += [raw[at:begin], own]
                at = begin + len(spelled[k])
                if self.bytes_of(own) != self.bytes_of(spelled[k]):
                    raise ValueError("segmentations of a part differ in what they spell")
            out.append((total - loss, np.frombuffer(b"".join([*made, raw[at:]]), np.int32)))
        return out

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, np.int32).tolist()))

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text; exact for what encode() gives where the model has byte pieces."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


_built: dict[tuple, Segmenter] = {}


def segmenter(vocab: Vocabulary, nbest: int, cache: int = CACHE) -> Segmenter:
    """The worker's own segmenter.  What it keeps of a task's parts goes with the task: a worker outlives its tasks."""
    key = (hash(vocab), nbest, cache)
    if key not in _built:
        _built.clear()
        _built[key] = Segmenter(vocab, nbest, cache)
    return _built[key]


def encode_documents(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text", nbest: int = NBEST, cache: int = CACHE) -> DataFrame:
    """(id, ids array<int>, n_pieces, scores array<double>, others array<array<int>>, round_trip) for every row.

    ``scores`` are those of the N best segmentations of the whole text, fewer if it has fewer; ``ids`` is the best
    one and ``others`` holds the next ones.  ``round_trip`` tells whether decoding ``ids`` gives the text back; where the others
    differ from them they spell the same, or an error is raised.
    An empty text is the space mark alone; a null text has no pieces, no scores and a null round_trip.  Ties go
    to one of the equals.  ``cache`` bounds the parts that a task keeps in each of two generations; it changes memory and
    time, not the result.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows_of(own: Segmenter, part: pa.RecordBatch) -> pa.RecordBatch:
        flat, counts, scores, trips, more, many = [], [], [], [], [], []
        texts = part.column(1).to_pylist()
        split = [None if t is None else own.parts(t) for t in texts]
        own.prepare([p for p in split if p])
        for text, parts in zip(texts, split, strict=True):
            if text is None:
                counts.append(0), scores.append([]), trips.append(None), many.append(0)
                continue
            found = own.best(text, parts)
            flat.append(found[0][1])
            counts.append(len(found[0][1]))
            scores.append([x for x, _ in found])
            more += [ids for _, ids in found[1:]]
            many.append(len(found) - 1)
            trips.append(own.decode(found[0][1]) == text)
        places = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = lambda arrays, sizes: pa.ListArray.from_arrays(places(sizes), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))
        others = pa.ListArray.from_arrays(places(many), lists(more, [len(x) for x in more]))
        columns = [part.column(0), lists(flat, counts), pa.array(counts, pa.int64()), pa.array(scores, pa.list_(pa.float64())), others, pa.array(trips, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["id", "ids", "n_pieces", "scores", "others", "round_trip"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(vocab, nbest, cache)
        gc.disable()  # millions of small tuples without cycles
        try:
            for part in slices(batches):
                yield rows_of(own, part)
        finally:
            own.kept, own.before = {}, {}
            gc.enable()

    schema = f"id {kind}, ids array<int>, n_pieces long, scores array<double>, others array<array<int>>, round_trip boolean"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)


def op7_nbest_pieces(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    """The two best segmentations of every text of ``documents`` and whether they decode to it; nulls as in encode_documents."""
    return encode_documents(load(spark, sf_dir, "documents"), Vocabulary.read(model))
