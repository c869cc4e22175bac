"""Two-pass external shuffle into shards, with DataFrame functions alone.

Pass 1 scatters whole records into memory-sized buckets by a seeded hash of their keys.  Pass 2 gathers each
bucket, permutes it with ``shuffle`` (Spark's is a seeded Fisher-Yates) and writes it.  The bucket's offset, a
running sum over bucket counts, places its records in one global order; each shard is a stretch of that order,
and stretches differ by one record at most.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, load, shared_dir, text_crc32, written

SEED = 17
BUCKET_BYTES = 16 << 20
LEAST = 256  # buckets at least, so that small inputs are spread as well
MOST_PARTITIONS = 100_000
SHARDS = 16
_STEP = 4096  # buckets in one stretch of the running sum


def file_row() -> list[Column]:
    """The key of a record that is read from files: its file's name and its row there."""
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def _offsets(buckets: DataFrame) -> DataFrame:
    """(b, sub, off): where each bucket begins; running sums within stretches of buckets, then over the stretches."""
    cells = cut(buckets.withColumn("g", F.expr(f"b div {_STEP}")))
    own = cells.selectExpr("b", "sub", "g", "sum(n) over (partition by g order by b, sub rows between unbounded preceding and current row) - n as within")
    sums = cells.groupBy("g").agg(F.sum("n").alias("n"))
    before = sums.selectExpr("g", "sum(n) over (order by g rows between unbounded preceding and current row) - n as before")
    return own.join(before, "g").selectExpr("b", "sub", "within + before as off")


def _dealt(at: Column, total: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place in the global order; the first shards take one record more each, if there is a remainder."""
    q, r = divmod(total, shards)
    head, rest = at < r * (q + 1), at - r * (q + 1)
    shard = F.when(head, F.floor(at / (q + 1))).otherwise(r + F.floor(rest / max(q, 1)))
    slot = F.when(head, F.pmod(at, F.lit(q + 1))).otherwise(F.pmod(rest, F.lit(max(q, 1))))
    return shard.cast("int"), slot.cast("long")


def write_shards(
    records: DataFrame, size: Column, path: str, key: list[Column] | None = None, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED, least: int = LEAST
) -> DataFrame:
    """Shuffles ``records``, writes them to ``path``, one folder for each shard, and reads them back.

    The result has the records' columns, ``slot`` (long, gapless from 0 in each shard) and ``shard`` (int).
    ``size`` gives a record's bytes (null: 0).  ``key`` tells records apart and must not change if a task is run
    again; without one the records are first written to the shared folder and known by file and row.  So equal
    records fall into different buckets.  A bucket holds ``bucket_bytes`` on average by a guess from the input's
    size; one that turns out to hold more than twice as much is split by a second hash.  Only a single record can
    exceed that.  The order depends on keys, seed and bucket count.  The law is ``rows``: counts differ by at
    most one.  Input columns named shard or slot are replaced; columns must be orderable (no maps).  An empty
    table gives an empty result.
    """
    spark = records.sparkSession
    records = records.drop(*[c for c in records.columns if c.lower() in ("shard", "slot")])
    if key is None:
        records, key = written(records, "records"), file_row()
    guess = 2 * int(str(records._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if guess >= 1 << 55:  # Spark does not know it
        guess = records.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(1, least, math.ceil(guess / bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(buckets)).cast("int").alias("b")
    again = F.xxhash64(F.lit(seed + 1), *key).alias("h")
    sizes = records.select(bucket, again, size.alias("size"))
    cells = sizes.groupBy("b").agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    cells = cut(cells.selectExpr("b", "n", f"if(bytes > {2 * bucket_bytes} and n > 1, cast(ceil(bytes / {bucket_bytes}) as long), 1L) as parts"))
    total, many, most = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("parts"), F.lit(0)), F.coalesce(F.max("parts"), F.lit(1))).first()
    scattered = records.select(bucket, again, F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("r"))
    first, second = F.lit(0).alias("sub"), F.expr("cast(pmod(h, parts) as int) as sub")
    held = cells.where("parts = 1").select("b", first, "n")
    if most > 1:  # the table of the buckets is small against the records: a join with it, split where keys are hot
        held = held.unionByName(sizes.join(cells.where("parts > 1").drop("n"), "b").select("b", second).groupBy("b", "sub").agg(F.count("*").alias("n")))
        scattered = scattered.join(cells.drop("n"), "b").select("b", second, "h", "r")
    else:
        scattered = scattered.select("b", first, "h", "r")
    # a bucket's offset travels with its records, which saves a join
    rows = scattered.select("b", "sub", F.struct("h", "r").alias("x"), F.lit(None).cast("long").alias("off"))
    rows = rows.unionByName(_offsets(held).select("b", "sub", F.lit(None).cast(rows.schema["x"].dataType).alias("x"), "off"))
    gathered = rows.repartition(max(1, min(many, MOST_PARTITIONS)), "b", "sub").groupBy("b", "sub").agg(F.max("off").alias("off"), F.array_sort(F.collect_list("x")).alias("rs"))
    placed = gathered.sortWithinPartitions("b", "sub")
    mixed = placed.select("off", F.shuffle("rs", seed).alias("rs"))
    rows = mixed.select("off", F.posexplode("rs").alias("k", "x"))
    shard, slot = _dealt(F.col("off") + F.col("k"), total, shards)
    out = rows.select("x.r.*", slot.alias("slot"), shard.alias("shard"))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def op9_two_pass_shuffle(spark, sf_dir: str) -> DataFrame:
    """``documents`` in 16 shards, written to the shared folder; sizes and checksums are of the texts read back.  A null text counts as none."""
    docs = load(spark, sf_dir, "documents")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    out = write_shards(docs, size, f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}", key=file_row())
    return out.select("doc_id", size.alias("size"), text_crc32(F.col("text")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
