"""Hierarchies of terms (IS_A, PART_OF) in which a term may have several parents.

The closure is found semi-naively: each round joins only the pairs that the last one found with the edges and keeps
those that are new, staged, until there are none.  A cycle therefore ends the loop too, and is reported.  For ancestor
tests on trees, terms get intervals within their root: one lies below another if its interval lies inside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import staged

ROUNDS = 200


def closure(edges: DataFrame) -> DataFrame:
    """(term, ancestor, distance) over edges (child, parent), with the smallest distance; a term on a cycle is its own ancestor.

    Null ends and repeated edges are dropped; an edge from a term to itself is a cycle of one.
    """
    step = staged(edges.where("child is not null and parent is not null").select("child", "parent").distinct(), "hierarchy")
    new = step.select(F.col("child").alias("term"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    rounds = [new]
    for distance in range(2, ROUNDS + 1):
        known = reduce(DataFrame.unionByName, rounds).select("term", "ancestor")
        up = new.join(step, F.col("ancestor") == F.col("child")).select("term", F.col("parent").alias("ancestor")).distinct()
        new = staged(up.join(known, ["term", "ancestor"], "left_anti").withColumn("distance", F.lit(distance)), "closure")
        if new.isEmpty():
            return reduce(DataFrame.unionByName, rounds)
        rounds.append(new)
    raise ValueError(f"the hierarchy is deeper than {ROUNDS} levels")


def on_cycles(pairs: DataFrame) -> DataFrame:
    """(term, length): the terms of a closure that are their own ancestors, and the length of the shortest way round."""
    return pairs.where("term = ancestor").select("term", F.col("distance").alias("length"))


def rollup(counts: DataFrame, pairs: DataFrame, term: str = "term", measure: str = "n") -> DataFrame:
    """(term, own, total): sums at each term and over it with all its descendants, each descendant once however many ways lead up.

    Terms that neither count nor have a counted descendant are absent.
    """
    own = counts.groupBy(F.col(term).alias("term")).agg(F.sum(measure).alias("own"))
    up = own.join(pairs.where("term <> ancestor"), "term").select(F.col("ancestor").alias("term"), F.lit(None).cast(own.schema["own"].dataType).alias("own"), F.col("own").alias("all"))
    both = own.select("term", "own", F.col("own").alias("all")).unionByName(up)
    return both.groupBy("term").agg(F.coalesce(F.max("own"), F.lit(0)).alias("own"), F.sum("all").alias("total"))


def intervals(edges: DataFrame) -> DataFrame:
    """(term, root, first, last) over a forest: a term's descendants have the numbers first + 1 to last within its root.

    Edges (child, parent) with a second parent, or a cycle, are refused.  Numbers follow the order of the ways from the root.
    """
    step = staged(edges.where("child is not null and parent is not null").select("child", "parent").distinct(), "forest")
    if not step.groupBy("child").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        raise ValueError("a term has several parents")
    now = staged(step.select(F.col("parent").alias("term")).distinct().join(step.select(F.col("child").alias("term")), "term", "left_anti").select("term", F.col("term").alias("root"), F.array("term").alias("way")), "roots")
    levels = [now]
    for _ in range(ROUNDS):
        now = staged(now.join(step, F.col("term") == F.col("parent")).select(F.col("child").alias("term"), "root", F.concat("way", F.array("child")).alias("way")), "level")
        if now.isEmpty():
            break
        levels.append(now)
    else:
        raise ValueError(f"the hierarchy is deeper than {ROUNDS} levels")
    every = reduce(DataFrame.unionByName, levels)
    below = every.select("root", F.explode("way").alias("term")).groupBy("root", "term").agg(F.count("*").alias("size"))
    if every.count() != step.select("child").union(step.select("parent")).distinct().count():
        raise ValueError("the hierarchy has a cycle")
    first = F.row_number().over(Window.partitionBy("root").orderBy("way")).cast("long")
    return every.withColumn("first", first).join(below, ["root", "term"]).select("term", "root", "first", (F.col("first") + F.col("size") - 1).alias("last"))
