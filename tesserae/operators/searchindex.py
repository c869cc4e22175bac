"""Substring search by an index of trigrams.

Rows are stored once, a folder for each task that wrote them, and a block is a range of a task's rows.  Each different
trigram of a row's small-lettered text is a posting, and a block's postings of one trigram are a list of the gaps
between places, so a list holds at most a block and common trigrams have many lists instead of long ones.  The lists lie
on shelves by a hash of the trigram, sorted by trigram.

A search reads the lists of the rarest trigrams of its text alone, intersects them block by block, and verifies what is
left on the stored rows of the tasks that have candidates.  A text of fewer than three characters scans the stored texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1 << 14  # rows of a block; a place in it has 15 bits at most
TASK = 1 << 33  # rows of a task have ids below this
SHELVES = 64
FOLDERS = 1000  # folders that a search names; beyond, all are listed
RAREST = 4  # trigrams whose lists that are intersected
LISTED = 1 << 21  # postings that a worker holds, beyond one row's (some 60 MB)


def trigrams(text: str) -> np.ndarray:
    """The different trigrams of a text, three code points of 21 bits each in a number."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:]) if len(points) > 2 else np.zeros(0, np.int64)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of (block, trigram) over the rows of a task that come one after another."""

    def lists(block: int, found: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        grams = np.concatenate([g for g, _ in found])
        places = np.repeat([p for _, p in found], [len(g) for g, _ in found]).astype(np.int64)
        order = np.lexsort((places, grams))
        grams, places = grams[order], places[order]
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        gaps = np.diff(places, prepend=0)
        gaps[starts] = places[starts]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(grams)), pa.int32()), pa.array(gaps, pa.int16()))
        return pa.RecordBatch.from_arrays([pa.array(grams[starts]), pa.array([block] * len(starts), pa.int64()), lists], names=["gram", "block", "gaps"])

    found, held, now = [], 0, None
    for b in batches:
        for place, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if held and (place // BLOCK != now or held > LISTED):
                yield lists(now, found)
                found, held = [], 0
            now, grams = place // BLOCK, trigrams(text.as_py() or "")
            found.append((grams, place % BLOCK))
            held += len(grams)
    if held:
        yield lists(now, found)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _places(gaps):
    return gaps.map(lambda g: np.cumsum(g, dtype=np.int32))


@dataclass
class SearchIndex:
    """An index under ``path``: ``rows`` with ``__place`` and ``__block`` (a folder each), ``lists`` and ``lexicon``."""

    spark: SparkSession
    path: str
    column: str

    @staticmethod
    def build(df: DataFrame, column: str, path: str) -> SearchIndex:
        """Indexes a column of ``df`` and stores all its columns beside it.  Null texts have no trigrams."""
        spark = df.sparkSession
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(TASK - 1))
        df.select("*", F.spark_partition_id().alias("__task"), place.alias("__place")).write.partitionBy("__task").parquet(f"{path}/rows")
        index = SearchIndex(spark, path, column)
        made = index.rows().select(F.col("__row"), F.lower(F.col(f"`{column}`").cast("string")).alias("text")).mapInArrow(_postings, "gram long, block long, gaps array<short>")
        made = made.withColumn("shelf", F.pmod(F.xxhash64("gram"), F.lit(SHELVES)).cast("int"))
        # lists of common trigrams are spread over the files of a shelf by their block
        spread = F.pmod(F.xxhash64("block"), F.lit(4))
        made = made.repartition(SHELVES * 4, "shelf", spread).sortWithinPartitions("shelf", "gram", "block")
        made.withColumn("n", F.size("gaps")).write.partitionBy("shelf").parquet(f"{path}/lists")
        index._lists().groupBy("shelf", "gram").agg(F.sum("n").alias("n")).repartition("shelf").sortWithinPartitions("gram").write.partitionBy("shelf").parquet(f"{path}/lexicon")
        return index

    def _lists(self) -> DataFrame:
        return self.spark.read.schema("gram long, block long, gaps array<short>, n int, shelf int").parquet(f"{self.path}/lists")

    def rows(self) -> DataFrame:
        """The stored rows with ``__task`` and ``__row``, their place among all rows."""
        return self.spark.read.parquet(f"{self.path}/rows").withColumn("__row", F.col("__task").cast("long") * TASK + F.col("__place")).drop("__place")

    def rarest(self, text: str) -> list[tuple[int, int, int]] | None:
        """(n, trigram, shelf) of the text's rarest trigrams, the rarest first; none if one is nowhere; null for a short text."""
        grams = trigrams(self._small(text))
        if not len(grams):
            return None
        wanted = self.spark.createDataFrame([(int(g),) for g in grams], "gram long").select("gram", F.pmod(F.xxhash64("gram"), F.lit(SHELVES)).cast("int").alias("shelf"))
        shelf = {r["gram"]: r["shelf"] for r in wanted.collect()}
        known = self.spark.read.schema("gram long, n long, shelf int").parquet(f"{self.path}/lexicon").where(F.col("shelf").isin(sorted(set(shelf.values()))) & F.col("gram").isin(sorted(shelf)))
        seen = sorted((r["n"], r["gram"], r["shelf"]) for r in known.collect())
        return seen[:RAREST] if len(seen) == len(grams) else []

    def _small(self, text: str) -> str:
        return self.spark.range(1).select(F.lower(F.lit(text))).first()[0]

    def _wanted(self, grams: list[tuple[int, int, int]]) -> DataFrame:
        return self._lists().where(F.col("shelf").isin(sorted({x for _, _, x in grams})) & F.col("gram").isin([g for _, g, _ in grams]))

    def candidates(self, text: str) -> DataFrame | None:
        """(__row) of the rows that have the text's rarest trigrams; null for a short text."""
        grams = self.rarest(text)
        if grams is None:
            return None
        if not grams:
            return self.spark.createDataFrame([], "__row long")
        of = self._wanted(grams).select("block", "gram", _places("gaps").alias("places"))
        each = of.groupBy("block").agg(*[F.flatten(F.collect_list(F.when(F.col("gram") == g, F.col("places")))).alias(f"p{i}") for i, (_, g, _) in enumerate(grams)])
        both = reduce(F.array_intersect, [F.col(f"p{i}") for i in range(len(grams))])  # lists of one block
        return each.select("block", F.explode(both).alias("p")).select((F.col("block") * BLOCK + F.col("p")).alias("__row"))

    def find(self, text: str) -> DataFrame:
        """The stored rows whose text contains ``text``, without regard to case."""
        near, rows = self.candidates(text), self.rows()
        holds = F.contains(F.lower(F.col(f"`{self.column}`").cast("string")), F.lit(self._small(text)))
        if near is not None:
            tasks = [r[0] for r in near.select(F.floor(F.col("__row") / TASK).cast("int")).distinct().limit(FOLDERS + 1).collect()]
            rows = rows.where(F.col("__task").isin(tasks)) if len(tasks) <= FOLDERS else rows
            rows = rows.join(near, "__row", "left_semi")
        return rows.where(holds).drop("__task", "__row")

    def cost(self, text: str) -> dict[str, int]:
        """Lists and postings that a search reads, rows that it verifies, and all rows."""
        near, grams, every = self.candidates(text), self.rarest(text), self.rows().count()
        if near is None:
            return {"lists": 0, "postings": 0, "verified": every, "rows": every}
        return {"lists": self._wanted(grams).count() if grams else 0, "postings": sum(n for n, _, _ in grams), "verified": near.count(), "rows": every}
