"""Assertions that contradict each other under like conditions, found from the signs of a cell and not from pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sign_cells(assertions: DataFrame, cell: list[str], key: str = "uid", sign: str = "sign", order: str = "ord") -> DataFrame:
    """(cell..., positive, negative, n_positive, n_negative): the counts of a cell's signs and the first assertion of each.

    Signs of zero and null ones take no side.  Partial aggregates suffice, however many assertions a cell has.
    """
    side = lambda test: F.min_by(F.when(test, F.col(key)), F.when(test, F.struct(order, key)))
    plus, minus = F.col(sign) > 0, F.col(sign) < 0
    return assertions.groupBy(*cell).agg(side(plus).alias("positive"), side(minus).alias("negative"), F.count_if(plus).alias("n_positive"), F.count_if(minus).alias("n_negative"))


def conflict_edges(assertions: DataFrame, cell: list[str], key: str = "uid", sign: str = "sign", order: str = "ord", evidence: str | None = None) -> DataFrame:
    """CONFLICTS_WITH edges (cell..., source, target, opposed): each assertion of a torn cell to the first one of the other sign.

    Two opposite assertions of a cell are thus two or three steps apart at most, by as many edges as assertions.
    ``opposed`` counts the other side; ``evidence``, a column of the source's own evidence, travels along.  A cell with
    a null in it is none.
    """
    torn = sign_cells(assertions, cell, key, sign, order).where("n_positive > 0 and n_negative > 0").dropna(subset=cell)
    carried = [evidence] if evidence else []
    both = assertions.where(F.col(sign) != 0).select(*cell, F.col(key).alias("source"), F.col(sign).alias("__sign"), *carried).join(torn, cell)
    plus = F.col("__sign") > 0
    target, n = F.when(plus, F.col("negative")).otherwise(F.col("positive")), F.when(plus, F.col("n_negative")).otherwise(F.col("n_positive"))
    return both.select(*cell, "source", target.alias("target"), n.alias("opposed"), *carried, F.lit("CONFLICTS_WITH").alias("edge_type"))


def explained_properties(claims: DataFrame, metrics: DataFrame) -> DataFrame:
    """EXPLAINS_PROPERTY edges (source, target, support): a claim to the properties measured on its catalyst under its reaction.

    ``claims`` has (claim, catalyst, reaction), ``metrics`` (metric, catalyst, reaction, property); support counts metrics.
    """
    measured = metrics.groupBy("catalyst", "reaction", "property").agg(F.count_distinct("metric").alias("support"))
    out = claims.distinct().join(measured, ["catalyst", "reaction"]).groupBy("claim", "property").agg(F.sum("support").alias("support"))
    return out.select(F.col("claim").alias("source"), F.col("property").alias("target"), "support", F.lit("EXPLAINS_PROPERTY").alias("edge_type"))
