"""Canonical layer: reactions merged into templates and catalysts into families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.materials import with_canonical_name
from ..functions.text import clean, first_text, list_or_empty, species, strip, text_or_empty


def latest_result(results: DataFrame, order: Column | None = None) -> DataFrame:
    """One row for each uid.  Where a result table has several, the last by ``order`` wins; without one, the last that is read."""
    tagged = results.where("uid is not null").withColumn("__n", F.monotonically_increasing_id() if order is None else order)
    names = [c for c in results.columns if c != "uid"]
    return tagged.groupBy("uid").agg(F.max_by(F.struct(*names), "__n").alias("r")).select("uid", "r.*")


def _sorted_families() -> Column:
    named = F.filter(list_or_empty("reaction_family"), lambda f: f != "")
    return F.array_sort(F.transform(named, lambda f: F.lower(strip(f))))


def _bar(parts: Column) -> Column:
    return F.when(F.size(parts) > 0, F.array_join(parts, "|")).otherwise("unknown")


def merge_key() -> Column:
    """The rule key of a reaction: domain, class, families, and its species or else its description."""
    low = lambda c: F.lower(strip(text_or_empty(c)))
    left, right = species("reactants"), species("target_products")
    head = [first_text(low("reaction_domain"), F.lit("unknown")), first_text(low("reaction_class"), F.lit("unknown")), _bar(_sorted_families())]
    described = F.substring(first_text(low("transformation"), low("reaction_name_reported"), F.lit("unknown")), 1, 120)
    by_species = F.concat_ws("||", *head, F.concat(F.lit("R:"), _bar(left)), F.concat(F.lit("P:"), _bar(right)))
    return F.when((F.size(left) > 0) | (F.size(right) > 0), by_species).otherwise(F.concat_ws("||", *head, F.concat(F.lit("T:"), described)))


def _numbered(clusters: DataFrame, prefix: str, key: str) -> DataFrame:
    """Ids in first-seen order, and a hash of the key that stays the same across runs.

    The running number needs one global order over the clusters; only (key, first) go through it.
    """
    number = clusters.select(key, F.row_number().over(Window.orderBy("ord")).alias("n"))
    return clusters.join(number, key).withColumns({"uid": F.concat(F.lit(prefix), F.col("n").cast("string")), "stable_id": F.sha2(key, 256)}).drop("n")


def _aliases(rows: DataFrame, key: str, column: str) -> DataFrame:
    each = rows.select(key, F.explode(list_or_empty(column)).alias("a")).select(key, strip("a").alias("a")).where("a <> ''")
    return each.groupBy(key).agg(F.array_sort(F.collect_set("a")).alias("canonical_aliases"))


def build_reaction_templates(reactions: DataFrame, results: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Template nodes and INSTANCE_OF_TEMPLATE edges.

    A normalisation result with a name wins over the rule key.  The first member of a cluster in
    document order represents it.
    """
    r = reactions.withColumn("rule", merge_key())
    if results is not None:
        got = latest_result(results).select("uid", clean("canonical_reaction_name").alias("name"), F.col("canonical_reaction_aliases").alias("result_aliases"))
        r = r.join(got.where("name <> ''"), "uid", "left")
    else:
        r = r.withColumns({"name": F.lit(None).cast("string"), "result_aliases": F.lit(None).cast("array<string>")})
    by_name = F.col("name").isNotNull()
    r = r.withColumn("merge_key", F.when(by_name, F.concat(F.lit("llm:"), F.lower("name"))).otherwise(F.concat(F.lit("rule:"), F.col("rule"))))
    carried = ["reaction_name_reported", "transformation", "reaction_domain", "reaction_class", "reaction_family", "reactants", "target_products", "name"]
    groups = r.groupBy("merge_key").agg(F.min("ord").alias("ord"), F.min_by(F.struct(*carried), "ord").alias("rep"), F.count("*").alias("instance_count"))
    groups = _numbered(groups, "rxn_template:RT", "merge_key").join(_aliases(r, "merge_key", "result_aliases"), "merge_key", "left")
    families = F.filter(list_or_empty("rep.reaction_family"), lambda f: f != "")
    label = F.when(F.size(list_or_empty("rep.reaction_family")) > 0, F.array_join(F.array_sort(F.transform(families, strip)), "_")).otherwise("unknown")
    nodes = groups.select(
        "uid",
        F.lit("ReactionTemplate").alias("node_type"),
        "ord",
        first_text("rep.name", "rep.reaction_name_reported", "rep.transformation", F.lit("unknown")).alias("template_name"),
        list_or_empty("canonical_aliases").alias("canonical_aliases"),
        *[F.col(f"rep.{c}").alias(c) for c in ("reaction_domain", "reaction_class", "reaction_family", "reactants", "target_products")],
        "instance_count",
        "merge_key",
        F.when(F.col("merge_key").startswith("llm:"), "llm").otherwise("rule").alias("merge_source"),
        label.alias("family_label"),
        "stable_id",
    )
    edges = r.select(F.col("uid").alias("source"), "merge_key", "paper_uid", "ord").join(nodes.select("merge_key", F.col("uid").alias("target")), "merge_key")
    return nodes, edges.select("source", "target", F.lit("INSTANCE_OF_TEMPLATE").alias("edge_type"), "paper_uid", "ord")


def dominant(rows: DataFrame, key: str, column: str, n: int = 3) -> DataFrame:
    """(key, column): the ``n`` most frequent labels of each key, ties by first occurrence."""
    each = rows.select(key, "ord", F.posexplode(list_or_empty(column)).alias("pos", "label")).where("label <> ''")
    counts = each.groupBy(key, "label").agg(F.count("*").alias("n"), F.min(F.struct("ord", "pos")).alias("first"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).where(F.col("rank") <= n)
    top = F.array_sort(F.collect_list(F.struct("rank", "label")))
    return ranked.groupBy(key).agg(F.transform(top, lambda x: x["label"]).alias(column))


def catalyst_names(catalysts: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Catalysts with their canonical family, member name and result aliases.

    The rows are persisted: half a dozen branches use them, and a filter on a name must not be pushed
    down through the rules, whose staged expressions would be substituted into one another.
    """
    if results is None:
        given = catalysts.withColumns({"given": F.lit(""), "result_name": F.lit(""), "result_aliases": F.lit(None).cast("array<string>")})
    else:
        family = first_text(strip(text_or_empty("canonical_catalyst_family")), strip(text_or_empty("canonical_name")))
        got = latest_result(results).withColumn("given", family)
        got = got.select("uid", "given", first_text(strip(text_or_empty("canonical_catalyst_name")), "given").alias("result_name"), F.col("canonical_aliases").alias("result_aliases"))
        given = catalysts.join(got, "uid", "left")
    named = with_canonical_name(given, None if results is None else "given", "canonical")
    return named.withColumn("member_name", first_text("result_name", "canonical")).persist()


def build_catalyst_families(catalysts: DataFrame, results: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Family nodes and INSTANCE_OF_FAMILY edges; clusters by the checked canonical name."""
    return families_of(catalyst_names(catalysts, results))


def families_of(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As build_catalyst_families, for catalysts that have their names (``catalyst_names``), which the caller may release."""
    members = F.transform(F.array_sort(F.collect_list(F.struct("ord", "uid"))), lambda x: x["uid"])
    groups = c.groupBy("canonical").agg(F.min("ord").alias("ord"), F.count("*").alias("instance_count"), members.alias("member_uids"))
    names = c.where("member_name <> ''").groupBy("canonical", "member_name").agg(F.min("ord").alias("first"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("first", "member_name"))), lambda x: x["member_name"])
    names = names.groupBy("canonical").agg(ordered.alias("member_canonical_names"))
    out = _numbered(groups, "cat_family:CF", "canonical")
    for extra in (names, _aliases(c, "canonical", "result_aliases"), dominant(c, "canonical", "labels_material_platform"), dominant(c, "canonical", "labels_active_site_form")):
        out = out.join(extra, "canonical", "left")
    nodes = out.select(
        "uid",
        F.lit("CatalystFamily").alias("node_type"),
        "ord",
        F.col("canonical").alias("canonical_name"),
        F.col("canonical").alias("canonical_catalyst_family"),
        list_or_empty("member_canonical_names").alias("member_canonical_names"),
        list_or_empty("canonical_aliases").alias("canonical_aliases"),
        "instance_count",
        "member_uids",
        list_or_empty("labels_material_platform").alias("dominant_material_platform"),
        list_or_empty("labels_active_site_form").alias("dominant_active_site_form"),
        "stable_id",
    )
    edges = c.select(F.col("uid").alias("source"), "canonical", "paper_uid", "ord").join(nodes.select(F.col("canonical_name").alias("canonical"), F.col("uid").alias("target")), "canonical")
    return nodes, edges.select("source", "target", F.lit("INSTANCE_OF_FAMILY").alias("edge_type"), "paper_uid", "ord")


def compression_report(names: DataFrame, name: str = "canonical_name", top: int = 25, singles: int = 20) -> dict:
    """Counts of rows, names and singletons, the largest merged names and the first singletons by name."""
    counts = names.groupBy(name).agg(F.count("*").alias("n"))
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("names"), F.count_if(F.col("n") == 1).alias("singletons")).first()
    largest = counts.orderBy(F.desc("n"), name).limit(top).collect()
    single = counts.where("n = 1").orderBy(name).limit(singles).collect()
    return row.asDict() | {"largest": [(r[name], r["n"]) for r in largest], "single": [r[name] for r in single]}


__all__ = ["build_catalyst_families", "build_reaction_templates", "catalyst_names", "compression_report", "dominant", "families_of", "latest_result", "merge_key"]
