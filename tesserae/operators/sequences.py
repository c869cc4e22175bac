"""Frequent ordered patterns of steps, and templates of procedures from them.

Sequences that are alike are sought through once, with their number.  Patterns grow by one step a round.  For each pattern a sequence keeps what follows the pattern's leftmost occurrence, so
the next round looks only at that; gaps between steps are allowed.  A pattern that too few sequences have is not grown,
as none that begins with it can be frequent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import staged


def frequent_patterns(sequences: DataFrame, least: int, longest: int = 5, key: str = "id", items: str = "items") -> tuple[DataFrame, DataFrame]:
    """(pattern, support) of the patterns of up to ``longest`` steps that at least ``least`` sequences have, and (key, pattern) of who has them.

    Null steps are left out, null and empty sequences have no pattern, and rows that share a key are sequences of their own only if they differ.
    """
    patterns, owners, bearers = _weighted_patterns(sequences, least, longest, key, items)
    return patterns, owners.join(bearers, "__bearer").select(key, "pattern")


def _weighted_patterns(sequences: DataFrame, least: int, longest: int, key: str, items: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pattern, support), (bearer, weight, pattern) and (bearer, key).

    Keys with one and the same sequence are one bearer, whose weight is their number, so patterns are sought once for
    each different sequence.  A key with several sequences is a bearer of its own.
    """
    steps = F.filter(F.col(items), lambda x: x.isNotNull())
    each = sequences.select(F.col(key), steps.alias("__rest"))
    ends = each.groupBy(key).agg(F.min("__rest").alias("__lo"), F.max("__rest").alias("__hi"))
    sole = ends.where(F.col("__lo") == F.col("__hi"))
    several = ends.where(F.col("__lo") != F.col("__hi")).select(F.col(key).alias("__k"))
    alone, own = F.struct(F.col("__lo").alias("steps"), F.lit(None).cast(each.schema[key].dataType).alias("key")), F.struct(F.lit(None).cast(each.schema["__rest"].dataType).alias("steps"), F.col(key).alias("key"))
    bearers = sole.select(alone.alias("__bearer"), key).unionByName(several.select(F.col("__k").alias(key)).select(own.alias("__bearer"), key))
    one = sole.groupBy("__lo").agg(F.count("*").alias("__n")).select(alone.alias("__bearer"), "__n", F.col("__lo").alias("__rest"))
    many = each.join(several, F.col(key).eqNullSafe(F.col("__k")), "left_semi").distinct().select(own.alias("__bearer"), F.lit(1).cast("long").alias("__n"), "__rest")
    now = staged(one.unionByName(many), "sequences").withColumn("pattern", F.slice("__rest", 1, 0))
    found, members = [], []
    for _ in range(longest):
        each = now.select("__bearer", "__n", "pattern", "__rest", F.explode(F.array_distinct("__rest")).alias("__step"))
        after = F.expr("slice(__rest, cast(array_position(__rest, __step) + 1 as int), size(__rest))")
        grown = staged(each.select("__bearer", "__n", F.concat("pattern", F.array("__step")).alias("pattern"), after.alias("__rest")), "patterns")
        support = staged(grown.select("__bearer", "__n", "pattern").distinct().groupBy("pattern").agg(F.sum("__n").alias("support")).where(F.col("support") >= least), "support")
        if support.isEmpty():
            break
        now = staged(grown.join(support.select("pattern"), "pattern", "left_semi"), "projected").select("__bearer", "__n", "pattern", "__rest")
        found.append(support)
        members.append(now.select("__bearer", "__n", "pattern").distinct())
    if not found:
        none = now.limit(0)
        return none.select("pattern", F.lit(0).cast("long").alias("support")), none.select("__bearer", "__n", "pattern"), bearers
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, members), bearers


def procedure_templates(sequences: DataFrame, least: int, longest: int = 5, key: str = "id", items: str = "items") -> tuple[DataFrame, DataFrame]:
    """Template nodes and edges: each sequence belongs to its longest frequent pattern, of these to the most frequent, then the first by its steps."""
    patterns, owners, bearers = _weighted_patterns(sequences, least, longest, key, items)
    ranked = owners.join(patterns, "pattern").withColumn("__k", F.row_number().over(Window.partitionBy("__bearer").orderBy(F.desc(F.size("pattern")), F.desc("support"), "pattern")))
    chosen = staged(ranked.where("__k = 1").select("__bearer", "__n", "pattern", "support"), "templates")
    uid = F.concat(F.lit("procedure_template:"), F.sha2(F.to_json("pattern"), 256))
    nodes = chosen.groupBy("pattern").agg(F.first("support").alias("support"), F.sum("__n").alias("instance_count"))
    edges = chosen.join(bearers, "__bearer").select(F.col(key).alias("source"), uid.alias("target"), F.lit("INSTANCE_OF_PROCEDURE_TEMPLATE").alias("edge_type"))
    return nodes.select(uid.alias("uid"), F.lit("ProcedureTemplate").alias("node_type"), "pattern", "support", "instance_count"), edges


def graph_sequences(nodes: dict[str, DataFrame], edge_tables: dict[str, DataFrame]) -> DataFrame:
    """(id, items): the step types of each procedure of an instance layer, in the steps' order."""
    has = edge_tables["HAS_STEP"].select(F.col("source").alias("id"), F.col("target").alias("uid"))
    steps = nodes["ProcedureStep"].select("uid", "ord", F.lower(F.trim("step_type")).alias("step")).where("step <> ''")
    listed = has.join(steps, "uid").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ord", "step"))).alias("s"))  # one procedure's steps
    return listed.select("id", F.transform("s", lambda x: x["step"]).alias("items"))
