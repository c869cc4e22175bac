"""Motifs of several vertices as acyclic joins, reduced by semi-joins before anything is joined.

A motif is a set of relations whose columns are its vertices.  Relations are taken off one by one, each hung under one
that has all the columns it shares with the rest; if that is not possible the motif is cyclic and refused.  Semi-joins up
and down this tree leave only rows that belong to some whole match, so no join makes rows that a later one drops.
Counts need no joins of matches at all: each relation sends its parent the number of partial matches for a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import staged
from .skew import HEAVY, salted_join


def join_tree(columns: dict[str, list[str]], root: str | None = None) -> list[tuple[str, str, list[str]]]:
    """(relation, parent, shared columns) from the leaves up; the one that is left is the root."""
    left, out = dict(columns), []
    while len(left) > 1:
        for name, cols in left.items():
            if name == root:
                continue
            others = {c for n, cs in left.items() if n != name for c in cs}
            shared = [c for c in cols if c in others]
            parent = next((n for n, cs in left.items() if n != name and set(shared) <= set(cs)), None)
            if parent and shared:
                out.append((name, parent, shared))
                del left[name]
                break
        else:
            raise ValueError("the motif has a cycle, falls apart or has no such root")
    return out


def reduced(relations: dict[str, DataFrame], root: str | None = None) -> dict[str, DataFrame]:
    """The relations' different rows that belong to some whole match; rows with a null belong to none.

    Each relation is staged after the way up and after the way down, so the passes read tables that only shrink.
    """
    tree = join_tree({n: r.columns for n, r in relations.items()}, root)
    now = {n: r.dropna().distinct() for n, r in relations.items()}
    for name, parent, shared in tree:
        now[name] = staged(now[name], f"motif-{name}")
        now[parent] = now[parent].join(now[name].select(*shared), shared, "left_semi")
    top = next(n for n in now if n not in {t[0] for t in tree})
    now[top] = staged(now[top], f"motif-{top}")
    for name, parent, shared in reversed(tree):
        now[name] = staged(now[name].join(now[parent].select(*shared), shared, "left_semi"), f"motif-{name}")
    return {n: now[n].select(*r.columns) for n, r in relations.items()}


def matches(relations: dict[str, DataFrame], root: str | None = None, heavy: int = HEAVY) -> DataFrame:
    """All different matches, a column for each vertex.  Vertices of very many rows are dealt over several tasks."""
    tree = join_tree({n: r.columns for n, r in relations.items()}, root)
    now = reduced(relations, root)
    for name, parent, shared in tree:
        now[parent] = salted_join(now[parent], now.pop(name), shared, heavy)
    return now.popitem()[1]


def match_counts(relations: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """(by..., n): how many different matches each value of ``by``, columns of one relation, has, rows with a null apart.  No match is formed."""
    root = next((n for n, r in relations.items() if set(by) <= set(r.columns)), None)
    if root is None:
        raise ValueError("no relation has all of these columns")
    now = {n: r.dropna().distinct().withColumn("__n", F.lit(1).cast("long")) for n, r in relations.items()}
    for name, parent, shared in join_tree({n: r.columns for n, r in relations.items()}, root):
        sent = now.pop(name).groupBy(*shared).agg(F.sum("__n").alias("__m"))
        now[parent] = now[parent].join(sent, shared).withColumn("__n", F.col("__n") * F.col("__m")).drop("__m")
    return now[root].groupBy(*by).agg(F.sum("__n").alias("n"))


def graph_motifs(edge_tables: dict[str, DataFrame], tagged: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """The motifs of the evidence graph by name, as relations over its edges.

    ``tagged`` has the edges from instances to terms.  A metric names one catalyst and one reaction, so a measurement
    is one relation; so is a procedure with a catalyst and a reaction of its own.
    """
    pick = lambda kind, a, b: edge_tables[kind].select(F.col("source").alias(a), F.col("target").alias(b)).distinct()
    tag = lambda kind, a, b: tagged.where(F.col("edge_type") == kind).select(F.col("source").alias(a), F.col("target").alias(b)).distinct()
    measured = pick("FOR_CATALYST", "metric", "catalyst").join(pick("UNDER_REACTION", "metric", "reaction"), "metric").join(tag("TESTS_PROPERTY", "metric", "property"), "metric")
    tested = measured.join(pick("HAS_METRIC", "point", "metric"), "metric").select("catalyst", "reaction", "point", "property")
    made = pick("APPLIES_TO", "procedure", "catalyst").join(pick("SPECIFIC_TO", "procedure", "reaction"), "procedure")
    on = edge_tables["APPLIES_TO_CATALYST"].select(F.col("source"), F.col("target").alias("catalyst"))
    seen = on.where("startswith(source, 'char:')").withColumnRenamed("source", "characterization")
    states = seen.join(tag("UNDER_SAMPLE_STATE", "characterization", "state"), "characterization").select("catalyst", "state").distinct()
    claimed = on.where("startswith(source, 'claim:')").withColumnRenamed("source", "claim").join(pick("ABOUT_REACTION", "claim", "reaction"), "claim")
    return {
        "catalyst_reaction_point_property": {"tested": tested},
        "procedure_catalyst_reaction_state": {"applies": pick("APPLIES_TO", "procedure", "catalyst"), "specific": pick("SPECIFIC_TO", "procedure", "reaction"), "states": states},
        "catalyst_procedure_reaction_point_property": {"made": made, "tested": tested},
        "catalyst_characterization_claim_reaction_property": {"seen": seen, "claimed": claimed, "measured": tested.select("catalyst", "reaction", "property").distinct()},
    }
