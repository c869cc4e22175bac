"""Absent pairs of a graph as hard negatives, matched in degree, for a split in time.

Each known pair keeps its source and draws another pair's target, so sources come as often as they do in the graph and
targets in proportion to their degrees.  Pairs are numbered once; a draw is a number that a digest of the seed, the pair
and the attempt fixes, looked up by a join, so every run gives the same pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import staged


def numbered(df: DataFrame, order: list[str], name: str = "place", ranges: int | None = None) -> DataFrame:
    """``df`` with the place of each row, from 0, in an order that tells rows apart.  Rows are numbered within ranges; only a count for each passes through one task."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    first = counts.selectExpr("__range", "sum(__n) over (order by __range) - __n as __first")  # a row for each range
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return rows.withColumn("__k", place).join(F.broadcast(first), "__range").withColumn(name, (F.col("__first") + F.col("__k")).cast("long")).drop("__range", "__k", "__first")


def hard_negatives(pairs: DataFrame, seed: int = 7, attempts: int = 4, known: DataFrame | None = None) -> DataFrame:
    """(source, target, negative, attempt) for each different pair: the first target drawn that the source is not linked to.

    ``known`` has further pairs that are no negatives, such as those of the later period.  Pairs whose every draw was
    a link are absent; two pairs of a source may have the same negative.  Pairs with a null are dropped.
    """
    own = pairs.select("source", "target").dropna().distinct()
    places = staged(numbered(own, ["source", "target"]), "pairs")
    n = places.count()
    links = own if known is None else own.unionByName(known.select("source", "target").dropna()).distinct()
    links = staged(links.select("source", F.col("target").alias("negative")), "links")
    targets = places.select("place", F.col("target").alias("negative"))
    left, found = places.select("source", "target"), []
    for attempt in range(attempts):  # a pair is drawn for again only if its last draw was a link
        digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("source").cast("string"), F.col("target").cast("string"), F.lit(str(attempt))), 256)
        place = F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(max(n, 1)))
        drawn = left.withColumn("place", place).join(targets, "place").select("source", "target", "negative")
        tried = drawn.join(links.withColumn("__linked", F.lit(True)), ["source", "negative"], "left")
        tried = staged(tried.select("source", "target", "negative", F.col("__linked").isNotNull().alias("linked")), "draws")
        found.append(tried.where("not linked").select("source", "target", "negative", F.lit(attempt).alias("attempt")))
        left = tried.where("linked").select("source", "target")
        if left.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)
