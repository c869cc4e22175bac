"""Graph checks and merges: duplicate edges and nodes, dangling edges, unions of graphs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDGE_KEY = ["source", "target", "edge_type"]


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One edge for each (source, target, edge_type), the first in order.  Measures are equal for equal keys."""
    names = [c for c in edges.columns if c not in EDGE_KEY]
    if "ord" not in names:
        return edges.dropDuplicates(EDGE_KEY)
    return edges.groupBy(*EDGE_KEY).agg(F.min_by(F.struct(*names), F.struct(F.col("ord").isNull(), "ord")).alias("x")).select(*EDGE_KEY, "x.*")


def valid_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose two ends exist."""
    uids = nodes.select("uid").distinct()
    out = edges.join(uids.withColumnRenamed("uid", "source"), "source", "left_semi")
    return out.join(uids.withColumnRenamed("uid", "target"), "target", "left_semi")


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges that lack an end."""
    uids = nodes.select("uid").distinct()
    no_source = edges.join(uids.withColumnRenamed("uid", "source"), "source", "left_anti")
    no_target = edges.join(uids.withColumnRenamed("uid", "source"), "source", "left_semi").join(uids.withColumnRenamed("uid", "target"), "target", "left_anti")
    return no_source.unionByName(no_target)


def repeated(nodes: DataFrame, *extra) -> DataFrame:
    """(uid, n) of the ids that occur more than once, with further aggregates on demand."""
    return nodes.groupBy("uid").agg(F.count("*").alias("n"), *extra).where("n > 1")


def assert_unique_nodes(nodes: DataFrame) -> None:
    """Raises with up to ten samples if a uid occurs twice."""
    twice = repeated(nodes)
    sample = [r["uid"] for r in twice.orderBy("uid").limit(10).collect()]
    if sample:
        raise ValueError(f"{twice.count()} node ids occur more than once, such as {', '.join(sample)}")


def merge_nodes(parts: list[DataFrame], by: str = "uid", order: Column | str | None = None) -> DataFrame:
    """Node tables of several runs in one; the first part that has an id gives its row.

    Within a part ``order`` decides (``ord``, if the parts have that column); without either, the order in which rows are read.
    """
    tagged = union_all(*[p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)])
    place = order if order is not None else "ord" if "ord" in tagged.columns else F.monotonically_increasing_id()
    tagged = tagged.withColumn("__pos", F.col(place) if isinstance(place, str) else place)
    names = [c for c in tagged.columns if c not in (by, "__part", "__pos")]
    return tagged.groupBy(by).agg(F.min_by(F.struct(*names), F.struct("__part", "__pos")).alias("x")).select(by, "x.*")


def merge_edges(parts: list[DataFrame]) -> DataFrame:
    return dedup_edges(union_all(*parts))


def merge_maps(parts: list[DataFrame], key: str, value: str) -> DataFrame:
    """Key-value tables of several runs in one; the last part that has a key gives its value."""
    tagged = union_all(*[p.select(key, value, F.lit(i).alias("__part")) for i, p in enumerate(parts)])
    return tagged.groupBy(key).agg(F.max_by(value, "__part").alias(value))


def chunks(rows: DataFrame, order: str, size: int, name: str = "batch") -> DataFrame:
    """``rows`` with a batch number of ``size`` consecutive places in a gapless 0-based ordinal."""
    return rows.withColumn(name, F.floor(F.col(order) / size).cast("bigint"))


def ranked(rows: DataFrame, partition: list[str], order: list, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("bigint"))


def incident(edges: DataFrame, uid: str) -> DataFrame:
    """The edges of one node, with the direction seen from it and the other end."""
    out = edges.where(F.col("source") == uid).select("edge_type", F.lit("out").alias("direction"), F.col("target").alias("other"))
    back = edges.where((F.col("target") == uid) & (F.col("source") != uid)).select("edge_type", F.lit("in").alias("direction"), F.col("source").alias("other"))
    return out.unionByName(back)
