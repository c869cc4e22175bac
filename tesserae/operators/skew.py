"""Equi-joins that spread keys of very many rows over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 50_000  # rows of one key on the left side that go to one task at most


def salted_join(left: DataFrame, right: DataFrame, on: list[str], heavy: int = HEAVY) -> DataFrame:
    """The inner join of two tables.  A key with more than ``heavy`` rows on the left is dealt over several tasks.

    Such a key's left rows are split into as many shares by a hash of the whole row, and its right rows go to each of
    them.  There is at most one such key for ``heavy`` rows of the left table, so their list stays small.
    """
    counts = left.groupBy(*on).agg(F.count("*").alias("__n")).where(F.col("__n") > heavy)
    hot = F.broadcast(counts.select(*on, F.ceil(F.col("__n") / heavy).cast("int").alias("__shares")))
    plain = [c for c in left.columns if not left.schema[c].dataType.typeName().startswith(("map", "variant"))]
    lefts = left.join(hot, on, "left").withColumn("__salt", F.when(F.col("__shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(*plain), F.col("__shares"))).cast("int"))
    rights = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__shares"), F.lit(1)) - 1)))
    return lefts.drop("__shares").join(rights.drop("__shares"), [*on, "__salt"]).drop("__salt")
