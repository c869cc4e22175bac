"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the setting is absent, a session on one machine (tests, the bench) gets a folder of its own; on a cluster
    that is an error, as executors would not see each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="tesserae-")
    sc.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut: written to the shared folder by checkpoint()."""
    spark = df.sparkSession
    where = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of a few rows, so that a worker holds few texts as Python strings at once.

    After the last one the worker, which serves later tasks too, gives unused Arrow memory back.
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
    pa.default_memory_pool().release_unused()


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame with its lineage cut: a compressed table in the shared folder, read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def unsigned32(c: Column) -> Column:
    return c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as no bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def bounded(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts whose texts in ``column`` hold up to ``size`` bytes together, or of one row with a longer text."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
            yield b.slice(at, to - at)
            at = to
        del b
    pa.default_memory_pool().release_unused()


def small(df: DataFrame, rows: int = 300_000) -> DataFrame:
    """A frame with its lineage cut, marked for broadcast if it has up to ``rows`` rows; larger ones are left to a shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
