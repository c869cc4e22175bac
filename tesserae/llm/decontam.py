"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of e edits is cut into e + 1 pieces; an occurrence within the
budget leaves at least one piece intact.  One automaton finds all exact piece hits in a document,
and Myers' bit-parallel distance verifies them, first around the piece, then around the item.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

RATE = 0.1  # edits allowed for each character of an item
BLOCK = 1_000_000  # characters of the items in one automaton (some 100,000 pieces and 150 MB in a worker)


def normal(text: str | None) -> str:
    """Lower case, white space collapsed."""
    return " ".join((text or "").lower().split())


def myers(pattern: str, masks: dict[str, int], text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``pattern`` inside ``text`` within ``budget``; the first end wins."""
    m = len(pattern)
    if not m:
        return None
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, (budget + 1, -1)
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best[0]:
                best = (score, j + 1)
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best if best[0] <= budget else None


def begin(pattern: str, text: str, distance: int) -> int:
    """The place in ``text`` where an occurrence that ends with it and has this distance begins; of several the one nearest in length."""
    back, m = text[::-1], len(pattern)
    masks: dict[str, int] = {}
    for p, c in enumerate(reversed(pattern)):
        masks[c] = masks.get(c, 0) | 1 << p
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = (m, 0) if m == distance else (m + distance + 1, 0)  # (how far the length is from the item's, length)
    for j, c in enumerate(back[: m + distance], 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        if score == distance:
            best = min(best, (abs(j - m), j))
        ph = ph << 1 & full | 1  # the occurrence is held at its end
        mh = mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return len(text) - best[1]


class Node:
    """A stretch of an item with its share of the error budget; leaves have none and are the pieces.

    Of two halves whose budgets sum to one less than the whole's, one keeps its own.  So an occurrence
    of the whole is found by verifying from an intact piece upwards, and a chance hit of a short
    piece is dismissed by its small parent already.
    """

    __slots__ = ("item", "lo", "hi", "budget", "parent", "text", "_masks")

    def __init__(self, item: int, text: str, lo: int, hi: int, budget: int, parent: Node | None):
        self.item, self.lo, self.hi, self.budget, self.parent, self.text = item, lo, hi, budget, parent, text[lo:hi]
        self._masks: dict[str, int] | None = None

    @property
    def masks(self) -> dict[str, int]:
        """The characters' bit masks, made when they are first needed: most stretches are never verified."""
        if self._masks is None:
            self._masks = {}
            for p, c in enumerate(self.text):
                self._masks[c] = self._masks.get(c, 0) | 1 << p
        return self._masks


def pieces(item: int, text: str, budget: int) -> list[Node]:
    """The budget-plus-one leaves of an item's tree, of about equal length."""
    todo, out = [Node(item, text, 0, len(text), budget, None)], []
    while todo:
        n = todo.pop()
        if not n.budget:
            out.append(n)
            continue
        left = (n.budget - 1) // 2
        right = n.budget - 1 - left
        mid = n.lo + (n.hi - n.lo) * (left + 1) // (n.budget + 1)
        todo += [Node(item, text, n.lo, mid, left, n), Node(item, text, mid, n.hi, right, n)]
    return out


class Matcher:
    """The automaton over all pieces; built once in each task."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items = [(i, t) for i, t in items if t]
        where: dict[str, list[Node]] = {}
        for k, (_, t) in enumerate(self.items):
            for leaf in pieces(k, t, int(len(t) * rate)):
                where.setdefault(leaf.text, []).append(leaf)
        self.auto = ahocorasick.Automaton()
        for piece, leaves in where.items():
            self.auto.add_word(piece, leaves)
        if where:
            self.auto.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best occurrence of each item, of equals the one that ends first."""
        if not self.items:
            return []
        body, best, seen = normal(text), {}, set()
        for end, leaves in self.auto.iter(body):
            for leaf in leaves:
                shift, node = end + 1 - leaf.hi, leaf.parent  # the item's start, if nothing before the piece is edited
                while node is not None:
                    e = node.budget
                    lo = max(0, shift + node.lo - e)
                    got = myers(node.text, node.masks, body[lo : shift + node.hi + e], e)
                    if got is None:
                        break
                    if node.parent is None:
                        best[node.item] = min(best.get(node.item, (e + 1,)), (got[0], lo + got[1]))
                        break
                    node = node.parent
                    if node.parent is None:  # the whole is verified once for each diagonal
                        if (node.item, shift) in seen:
                            break
                        seen.add((node.item, shift))
                if leaf.parent is None:
                    best[leaf.item] = min(best.get(leaf.item, (1,)), (0, end + 1))
        out = []
        for k, (distance, end) in sorted(best.items()):
            name, pattern = self.items[k]
            lo = max(0, end - len(pattern) - distance)
            out.append((name, distance, lo + begin(pattern, body[lo:end], distance), end))
        return out


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about BLOCK characters, one after the other; each block alone reaches the driver."""
    rows = items.select(F.col(item_col), F.col(text_col)).toDF("item", "text").where("item is not null and text is not null")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK))
    for k in range(n):
        some = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield sorted((r[0], normal(r[1])) for r in some.collect())


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(id, item, distance, start, end): each test item that occurs in a document within its budget, once.

    Both texts are lower-cased and their white space collapsed; places count code points of that
    form, ``end`` exclusive.  The budget is ``rate`` of the item's length.  A document may have several items.  Items
    that are null or blank never match, nor do null or empty documents; repeated rows give repeated
    results.  Whole texts are searched.  A test set of more than BLOCK characters is taken in blocks, each with a scan
    of the documents.
    """
    kind, ikind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()

    def run(known: list[tuple[int, str]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(known, rate)
        for b in slices(batches):
            ids, rows = b.column(0), []
            for at, text in enumerate(b.column(1).to_pylist()):
                rows += [(at, *hit) for hit in matcher.find(text)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            where = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(where), pa.array(cols[1], schema_item), *(pa.array(c, pa.int32()) for c in cols[2:])],
                names=["id", "item", "distance", "start", "end"],
            )

    schema_item = pa.int64() if ikind == "bigint" else pa.int32() if ikind == "int" else pa.string()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = [rows.mapInArrow(partial(run, known), f"id {kind}, item {ikind}, distance int, start int, end int") for known in _blocks(items, item_col, item_text)]
    return reduce(DataFrame.unionByName, parts).withColumnsRenamed({"id": id_col, "item": item_col})


def op10_pigeonhole_decontamination(spark, sf_dir: str) -> DataFrame:
    """The items of ``benchmark`` that occur in texts of ``documents``, with distance and place; nulls and ties as in leaks()."""
    from .common import load

    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
