"""Statistics of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bridge import PAIRS

LIKELY = sorted({p[2] for p in PAIRS})


def count_by(df: DataFrame, column: str) -> DataFrame:
    """(column, n), most frequent first, ties by name."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def cluster_stats(clusters: DataFrame, size: str = "instance_count") -> DataFrame:
    """One row: count, avg_instances, max_instances, singleton_count; zeros for an empty table."""
    return clusters.agg(
        F.count("*").alias("count"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("avg_instances"),
        F.coalesce(F.max(size), F.lit(0)).alias("max_instances"),
        F.count_if(F.col(size) == 1).alias("singleton_count"),
    )


def graph_stats(nodes: DataFrame, edges: DataFrame) -> dict:
    """The report of a graph.  Every table that reaches the driver has a row for each type, at most.

    A graph without clusters, whose nodes have no ``instance_count``, reports zeros for them.
    """
    if "instance_count" not in nodes.columns:
        nodes = nodes.withColumn("instance_count", F.lit(None).cast("bigint"))
    as_dict = lambda df, c: {r[c]: r["n"] for r in count_by(df, c).collect()}
    by_node, by_edge = as_dict(nodes, "node_type"), as_dict(edges, "edge_type")
    clusters = lambda t: cluster_stats(nodes.where(F.col("node_type") == t)).first().asDict()
    retired = edges.where("edge_type = 'CO_STUDIED_WITH'")
    average = retired.agg(F.coalesce(F.avg("co_occurrence_count"), F.lit(0.0))).first()[0] if by_edge.get("CO_STUDIED_WITH") else 0
    return {
        "summary": {"total_nodes": sum(by_node.values()), "total_edges": sum(by_edge.values()), "unique_node_types": len(by_node), "unique_edge_types": len(by_edge)},
        "nodes_by_type": by_node,
        "edges_by_type": by_edge,
        "ontology_terms_by_type": as_dict(nodes.where("node_type = 'OntologyTerm'"), "ontology_type"),
        "reaction_templates": clusters("ReactionTemplate"),
        "catalyst_families": clusters("CatalystFamily"),
        "co_studied_edges": {"count": by_edge.get("CO_STUDIED_WITH", 0), "avg_co_occurrence": round(average, 2)},
        "similarity_edges": {"count": by_edge.get("SIMILAR_TO", 0)},
        "tested_in_template_edges": {"count": by_edge.get("TESTED_IN_TEMPLATE", 0)},
        "likely_edges": {"count": sum(by_edge.get(t, 0) for t in LIKELY)},
    }


def growth(rows: DataFrame, keys: list[str], year: str, since: int, least: int) -> DataFrame:
    """(keys, observed, future, growth): occurrences before and from a year on, for keys that were seen ``least`` times before."""
    counts = rows.groupBy(*keys).agg(F.count_if(F.col(year) < since).alias("observed"), F.count_if(F.col(year) >= since).alias("future"))
    return counts.where(F.col("observed") >= least).withColumn("growth", F.col("future") / F.col("observed").cast("double"))


def motifs(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, n) of the combinations of tags that occur together ``least`` times."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def report(stats: dict) -> str:
    """The report as text."""
    s = stats["summary"]
    out = [f"nodes {s['total_nodes']} of {s['unique_node_types']} types, edges {s['total_edges']} of {s['unique_edge_types']} types"]
    for title, key in (("Nodes", "nodes_by_type"), ("Edges", "edges_by_type"), ("Ontology terms", "ontology_terms_by_type")):
        out += ["", title, *(f"  {name:30s} {n:>8d}" for name, n in stats[key].items())]
    for title, key in (("Reaction templates", "reaction_templates"), ("Catalyst families", "catalyst_families")):
        c = stats[key]
        out += ["", f"{title}: {c['count']}, {c['singleton_count']} of one instance, {c['avg_instances']:.1f} on average, {c['max_instances']} at most"]
    out += ["", f"Likely {stats['likely_edges']['count']}, similar {stats['similarity_edges']['count']}, lifted {stats['tested_in_template_edges']['count']}"]
    return "\n".join(out)
