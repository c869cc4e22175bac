"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest of them and itself.

    Large: only neighbours above the node are moved.  Small: only neighbours below it, and the node.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        low = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))  # so the join with a hub's edges can be split
        out = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b")
    else:
        down = both.where("b < a")
        low = cut(down.groupBy("a").agg(F.min("b").alias("m")))
        moved = down.join(low, "a").where("b <> m").select(F.col("m").alias("a"), "b")
        out = moved.unionByName(low.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Each step replaces edges by stars, so its size never exceeds the edges given, and O(log n)
    rounds suffice.  The lineage is cut by checkpoint() after each round.  The loop ends when a
    round changes nothing, which a count and a hash sum over the edges show.
    """
    current = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    mark = None
    for _ in range(ROUNDS):
        current = cut(_star(_star(current, True), False))
        seen = current.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("connected components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
