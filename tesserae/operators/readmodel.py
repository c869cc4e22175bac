"""Read models of the viewers, and the queries that they run over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import LIKELY

# The edge types of each task group, and the prefix that splits a shared type.
TASK_GROUPS = {
    "task1": ["HAS_REACTION", "IN_DOMAIN", "IN_CLASS", "IN_FAMILY", "INSTANCE_OF_TEMPLATE"],
    "task2": ["HAS_CATALYST", "TESTED_IN", "HAS_MATERIAL_PLATFORM", "HAS_ACTIVE_SITE_FORM", "HAS_MORPHOLOGY_FORM", "HAS_FORM_FACTOR", "INSTANCE_OF_FAMILY"],
    "task3": ["HAS_PROCEDURE", "APPLIES_TO", "SPECIFIC_TO", "HAS_STEP", "NEXT_STEP", "IN_PROCEDURE_TYPE", "IN_STEP_TYPE"],
    "task4": ["HAS_CHARACTERIZATION", "LINKED_TO_REACTION", "UNDER_SAMPLE_STATE", "USES_METHOD", "APPLIES_TO_CATALYST (from Char)"],
    "task5": ["HAS_PERFORMANCE_DATASET", "HAS_OPERATING_POINT", "HAS_METRIC", "FOR_CATALYST", "UNDER_REACTION", "TESTS_PROPERTY", "TESTS_TARGET_SPECIES", "TESTS_UNDER_BASIS", "UNDER_CATALYST_STATE", "TESTS_PROPERTY_TYPE"],
    "task6": ["HAS_MECHANISTIC_CLAIM", "ABOUT_REACTION", "HAS_EVIDENCE", "SUPPORTED_BY", "HAS_CLAIM_TYPE", "HAS_TAG", "HAS_EVIDENCE_TYPE", "APPLIES_TO_CATALYST (from Claim)"],
    "bridge": ["LIKELY_USES", "LIKELY_ASSOCIATED_WITH", "LIKELY_SUPPORTS", "TESTED_IN_TEMPLATE", "SIMILAR_TO"],
}
NODE_ORDER = ["Paper", "Reaction", "Catalyst", "Procedure", "ProcedureStep", "CharacterizationRecord", "PerformanceDataset", "OperatingPoint", "Metric", "MechanisticClaim", "EvidenceItem"]


def split_type() -> Column:
    """The edge type, with the shared APPLIES_TO_CATALYST split by its source."""
    t, s = F.col("edge_type"), F.col("source")
    shared = t == "APPLIES_TO_CATALYST"
    out = F.when(shared & s.startswith("char:"), "APPLIES_TO_CATALYST (from Char)")
    return out.when(shared & s.startswith("claim:"), "APPLIES_TO_CATALYST (from Claim)").otherwise(t)


def task_rollup(edges: DataFrame, groups: dict[str, list[str]] = TASK_GROUPS) -> DataFrame:
    """(task, edge_type, n, task_total); types without edges stay with 0."""
    dim = edges.sparkSession.createDataFrame([(g, t) for g, ts in groups.items() for t in ts], "task string, edge_type string")
    counts = edges.groupBy(split_type().alias("edge_type")).agg(F.count("*").alias("n"))
    out = dim.join(counts, "edge_type", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("task_total", F.sum("n").over(Window.partitionBy("task")))


def labels(nodes: DataFrame) -> DataFrame:
    """(uid, label, node_type): display name, reported name, short title, local id or uid."""
    have = set(nodes.columns)
    pick = [F.nullif(F.substring(c, 1, 50) if c == "title" else F.col(c), F.lit("")) for c in ("display_name", "name_reported", "title", "local_id") if c in have]
    return nodes.select("uid", F.coalesce(*pick, "uid").alias("label"), "node_type")


def cooccurrence_rows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Likely edges with the names and types of their terms, most witnessed first."""
    terms = nodes.where("node_type = 'OntologyTerm'").select("uid", "display_name", "ontology_type")
    out = edges.where(F.col("edge_type").isin(LIKELY))
    for end in ("source", "target"):
        out = out.join(terms.select(F.col("uid").alias(end), F.col("display_name").alias(f"{end}_name"), F.col("ontology_type").alias(f"{end}_onto_type")), end, "left")
        out = out.withColumn(f"{end}_name", F.coalesce(f"{end}_name", end))
    return out.orderBy(F.desc("witness_paper_count"), F.desc("co_occurrence_count"), "source", "target", "edge_type")


def edge_samples(nodes: DataFrame, edges: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` edges of each type in document order, with labels."""
    order = [F.col("ord").asc_nulls_last(), "source", "target"]
    first = edges.withColumn("rank", F.row_number().over(Window.partitionBy("edge_type").orderBy(*order))).where(F.col("rank") <= n)
    out = first.select("edge_type", "rank", "source", "target")
    names = labels(nodes)
    for end in ("source", "target"):
        out = out.join(names.select(F.col("uid").alias(end), F.col("label").alias(f"{end}_label"), F.col("node_type").alias(f"{end}_type")), end, "left")
    return out


def paper_titles(nodes: DataFrame) -> DataFrame:
    return nodes.where("node_type = 'Paper'").select("uid", "title", "doi", "year")


def explorer_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, edge types, likely edges, likely edges of several documents."""
    likely = F.col("edge_type").isin(LIKELY)
    counts = edges.agg(
        F.count("*").alias("total_edges"),
        F.count_distinct("edge_type").alias("total_edge_types"),
        F.count_if(likely).alias("total_co_occur"),
        F.count_if(likely & (F.col("witness_paper_count") > 1)).alias("cross_paper_co_occur"),
    )
    return counts.crossJoin(nodes.agg(F.count_distinct("uid").alias("total_nodes")))  # one row each


def packed(rows: DataFrame, by: str, columns: list[str], name: str) -> DataFrame:
    """One row for each value of ``by`` with its rows as a sorted list of structs."""
    return rows.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def _with_paper(own: DataFrame, edges: DataFrame) -> DataFrame:
    """``edges`` with ``p``: the document that both ends are of, or that the end beside a term is of; null where there is none."""
    inside = own.select(F.col("uid").alias("source"), F.col("paper_uid").alias("sp"))
    ends = own.select(F.col("uid").alias("target"), F.col("paper_uid").alias("tp"))
    e = edges.join(inside, "source", "left").join(ends, "target", "left")
    return e.withColumn("p", F.when(F.col("sp") == F.col("tp"), F.col("sp")).when(F.col("target").startswith("onto:"), F.col("sp")).when(F.col("source").startswith("onto:"), F.col("tp")))


def bundle_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(paper_uid, year, doi, n_nodes, n_edges): how many nodes and edges each bundle of ``paper_bundles`` has, without its lists."""
    own = nodes.where("paper_uid is not null")
    listed = own.groupBy("paper_uid").agg(F.count("*").alias("n_nodes"))
    links = _with_paper(own, edges.select("source", "target")).where("p is not null").groupBy(F.col("p").alias("paper_uid")).agg(F.count("*").alias("n_edges"))
    heads = nodes.where("node_type = 'Paper'").select("paper_uid", "doi", "year")
    out = heads.join(listed, "paper_uid", "left").join(links, "paper_uid", "left")
    return out.select("paper_uid", "year", "doi", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_nodes", "n_edges")])


def packed_bundles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of ``paper_bundles`` in no order."""
    own = nodes.where("paper_uid is not null")
    listed = packed(own, "paper_uid", ["ord", "uid", "node_type"], "nodes")
    listed = listed.select("paper_uid", F.transform("nodes", lambda x: F.struct(x["uid"].alias("uid"), x["node_type"].alias("node_type"))).alias("nodes"))
    e = _with_paper(own, edges)
    links = packed(e.where("p is not null").withColumn("paper_uid", F.col("p")), "paper_uid", ["source", "target", "edge_type"], "edges")
    heads = nodes.where("node_type = 'Paper'").select("paper_uid", "doi", "title", "year")
    return heads.join(listed, "paper_uid", "left").join(links, "paper_uid", "left")


def in_order(bundles: DataFrame) -> DataFrame:
    """Bundles by year, DOI and id.  The sort runs over its rows twice, so stage large ones first."""
    return bundles.orderBy(F.coalesce("year", F.lit(0)), "doi", "paper_uid")


def paper_bundles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(paper_uid, doi, title, year, nodes, edges) by year, DOI and id: a document's nodes, and its edges among them and to terms.

    One document's rows make one list, so the lists are bounded by the largest document.
    """
    return in_order(packed_bundles(nodes, edges))


def type_counts_by_paper(nodes: DataFrame) -> DataFrame:
    """(paper_uid, node_type, n, place) in the viewers' type order."""
    return with_place(nodes.where("paper_uid is not null").groupBy("paper_uid", "node_type").agg(F.count("*").alias("n")))


def with_place(counts: DataFrame) -> DataFrame:
    """``counts`` with the place of each node type in the viewers' order."""
    return counts.withColumn("place", F.array_position(F.array(*[F.lit(t) for t in NODE_ORDER]), F.col("node_type")))


def type_breakdown(edges: DataFrame, types: list[str] = LIKELY) -> DataFrame:
    """(edge_type, n, cross_paper, percent): the edges of some types (the likely ones) by type, and their share of the largest."""
    out = edges.where(F.col("edge_type").isin(types)).groupBy("edge_type").agg(F.count("*").alias("n"), F.count_if(F.col("witness_paper_count") > 1).alias("cross_paper"))
    return out.withColumn("percent", F.col("n") * 100.0 / F.max("n").over(Window.partitionBy()))


def of_types(rows: DataFrame, text: str, column: str = "edge_type") -> DataFrame:
    """Rows whose type contains a text, without regard to case; an empty text takes all."""
    return rows.where(F.contains(F.lower(column), F.lit(text.lower()))) if text else rows


def cross_paper(edges: DataFrame) -> DataFrame:
    """Edges that more than one document witnesses."""
    return edges.where("witness_paper_count > 1")


def top_edge_types(edges: DataFrame, n: int = 20) -> DataFrame:
    return edges.groupBy("edge_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "edge_type").limit(n)


def search(df: DataFrame, text: str, columns: list[str] | None = None) -> DataFrame:
    """Rows that contain a text, in any of some columns or anywhere in the row; case is ignored."""
    q = F.lit(text.lower())
    if columns is None:
        return df.where(F.contains(F.lower(F.to_json(F.struct("*"))), q))
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), q), F.lit(False))
    return df.where(test)


def sort_by(df: DataFrame, column: str, descending: bool = False, tie: str | None = None) -> DataFrame:
    """Rows by a user's column, strings without regard to case."""
    c = F.lower(column) if df.schema[column].dataType.typeName() == "string" else F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), *([tie] if tie else []))


def neighbours(df: DataFrame, order: list, key: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the keys before and after each row in a filtered list.

    Rows are sorted within ranges of the order; only the first and last key of each range pass through one task.
    ``order`` must end in a column that tells rows apart; keys are not null.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
    w = Window.partitionBy("__range").orderBy(*order)
    rows = rows.withColumns({"previous": F.lag(key).over(w), "next": F.lead(key).over(w)})
    ends = rows.groupBy("__range").agg(F.max(F.when(F.col("previous").isNull(), F.col(key))).alias("first"), F.max(F.when(F.col("next").isNull(), F.col(key))).alias("last"))
    across = Window.orderBy("__range")
    ends = ends.select("__range", F.lag("last").over(across).alias("__before"), F.lead("first").over(across).alias("__after"))
    out = rows.join(F.broadcast(ends), "__range")  # a row for each range
    return out.select(*df.columns, F.coalesce("previous", "__before").alias("previous"), F.coalesce("next", "__after").alias("next"))


def page_after(df: DataFrame, order: str, after, size: int) -> DataFrame:
    """The next page of a list by its last key: a top-n without a running number."""
    rows = df if after is None else df.where(F.col(order) > F.lit(after))
    return rows.orderBy(order).limit(size)
