"""Bridge layer: relations across documents, from co-occurrence, lifting and similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import list_or_empty, strip, two_decimals

# The directed pairs of ontology types that may be linked, and the link's type.
PAIRS = [
    ("reaction_family", "material_platform", "LIKELY_USES"),
    ("reaction_family", "active_site_form", "LIKELY_ASSOCIATED_WITH"),
    ("active_site_form", "property_name", "LIKELY_ASSOCIATED_WITH"),
    ("material_platform", "property_name", "LIKELY_ASSOCIATED_WITH"),
    ("reaction_family", "step_type", "LIKELY_ASSOCIATED_WITH"),
    ("material_platform", "step_type", "LIKELY_ASSOCIATED_WITH"),
    ("active_site_form", "step_type", "LIKELY_ASSOCIATED_WITH"),
    ("reaction_family", "design_mechanism_tag", "LIKELY_SUPPORTS"),
    ("active_site_form", "design_mechanism_tag", "LIKELY_SUPPORTS"),
    ("material_platform", "design_mechanism_tag", "LIKELY_SUPPORTS"),
    ("property_name", "design_mechanism_tag", "LIKELY_SUPPORTS"),
]
# Platforms too common to make two families similar.
COMMON_PLATFORMS = ["supported_metal_nanoparticles", "metal_oxides_hydroxides_oxyhydroxides", "composites_heterostructures", "other"]


Edges = DataFrame | dict[str, DataFrame]  # one table, or one for each type


def _of(edges: Edges, edge_type: str) -> DataFrame:
    return edges[edge_type] if isinstance(edges, dict) else edges.where(F.col("edge_type") == edge_type)


def _kind(edges: Edges, edge_type: str, source: str, target: str) -> DataFrame:
    return _of(edges, edge_type).select(F.col("source").alias(source), F.col("target").alias(target))


def _with_own(rows: DataFrame, key: str, own: DataFrame) -> DataFrame:
    """(ctx, paper_uid, member): the nodes of ``key`` and the nodes ``own`` gives to each; one node's list is one row's."""
    lists = own.groupBy(key).agg(F.collect_list("own").alias("own"))
    return rows.join(lists, key, "left").select("ctx", "paper_uid", F.explode(F.concat(F.array(key), list_or_empty("own"))).alias("member"))


def contexts(edges: Edges, legs: set[str] | None = None, colon_ids: bool = True) -> DataFrame:
    """(ctx, paper_uid, member): the instance nodes around each tested pair of catalyst and reaction.

    ``ctx`` is the pair's own place, so a repeated pair makes two contexts.  Legs: ``pair``,
    ``procedure`` (with steps; procedures of the catalyst that name no reaction or this one),
    ``characterization``, ``performance`` (with points and metrics of this catalyst), ``claim`` (with
    evidence).  With ``colon_ids`` false, documents whose id has a colon form none.
    """
    legs = legs or {"pair", "procedure", "characterization", "performance", "claim"}
    pair = _of(edges, "TESTED_IN").select(F.col("ord").alias("ctx"), "paper_uid", F.col("source").alias("cat"), F.col("target").alias("rxn"))
    if not colon_ids:
        pair = pair.where(~F.substring("paper_uid", 7, 1 << 30).contains(":"))
    head = ["ctx", "paper_uid"]
    out = []
    if "pair" in legs:
        out.append(pair.select(*head, F.explode(F.array("cat", "rxn")).alias("member")))
    if "procedure" in legs:
        named = _kind(edges, "SPECIFIC_TO", "proc", "rxn").distinct()
        procs = pair.join(_kind(edges, "APPLIES_TO", "proc", "cat").distinct(), "cat")
        procs = procs.join(named.select("proc").distinct().withColumn("names", F.lit(True)), "proc", "left").join(named.withColumn("this", F.lit(True)), ["proc", "rxn"], "left")
        out.append(_with_own(procs.where("names is null or this").select(*head, "proc"), "proc", _kind(edges, "HAS_STEP", "proc", "own")))
    on = _of(edges, "APPLIES_TO_CATALYST").select(F.col("source").alias("member"), F.col("target").alias("cat")).distinct()
    if "characterization" in legs:
        out.append(pair.join(on.where("startswith(member, 'char:')"), "cat").select(*head, "member"))
    if "performance" in legs:
        perf = pair.join(_kind(edges, "HAS_PERFORMANCE_DATASET", "rxn", "perf").distinct(), "rxn")
        out.append(perf.select(*head, F.col("perf").alias("member")))
        mine = _kind(edges, "FOR_CATALYST", "metric", "cat").join(_kind(edges, "UNDER_REACTION", "metric", "rxn"), "metric")
        measured = mine.join(_kind(edges, "HAS_METRIC", "op", "metric"), "metric").join(_kind(edges, "HAS_OPERATING_POINT", "perf", "op"), "op")
        hit = perf.join(measured, ["cat", "rxn", "perf"])
        out.append(hit.select(*head, F.explode(F.array("op", "metric")).alias("member")))
    if "claim" in legs:
        # from the pair to the claims of its catalyst; claims joined to reactions first would be all their pairs
        claims = pair.join(on.where("startswith(member, 'claim:')"), "cat").join(_kind(edges, "ABOUT_REACTION", "member", "rxn").distinct(), ["member", "rxn"])
        out.append(_with_own(claims.select(*head, "member"), "member", _kind(edges, "HAS_EVIDENCE", "member", "own")))
    return reduce(DataFrame.unionByName, out)


#: The legs whose members can carry a type of PAIRS, by that type.
LEG_OF = {"reaction_family": "pair", "material_platform": "pair", "active_site_form": "pair", "step_type": "procedure", "property_name": "performance", "design_mechanism_tag": "claim"}


def gathered(tags: DataFrame) -> DataFrame:
    """(ctx, paper_uid, tags): the rows (ctx, paper_uid, year, tag, type) of each context, which lies in one document, as one list."""
    return tags.groupBy("paper_uid", "ctx").agg(F.collect_list(F.struct("type", "tag", "year")).alias("tags"))


def pair_up(tags: DataFrame, pairs: list[tuple[str, str, str]] = PAIRS, witnesses: bool = True) -> DataFrame:
    """Directed edges between tags (ctx, paper_uid, year, tag, type) of a context, with counts and witnesses.

    Without ``witnesses``, the papers are counted and not listed.
    """
    used = sorted({t for p in pairs for t in p[:2]})
    return pair_lists(gathered(tags.where(F.col("type").isin(used))), pairs, witnesses)


def pair_lists(contexts: DataFrame, pairs: list[tuple[str, str, str]] = PAIRS, witnesses: bool = True) -> DataFrame:
    """``pair_up`` for contexts that come with their tags as one list (paper_uid, tags), as ``gathered`` makes them.

    Each allowed pair of types is looked up from its source side within the list; the table of pairs has a dozen rows.
    Rows of a document that are in one task already stay there until its own counts are made.
    """
    allowed = F.broadcast(contexts.sparkSession.createDataFrame(pairs, "type string, to_type string, edge_type string"))
    left = contexts.select("paper_uid", "tags", F.explode("tags").alias("a")).join(allowed, F.col("a.type") == F.col("type"))
    right = F.filter("tags", lambda b: b["type"] == F.col("to_type"))
    both = left.select("paper_uid", F.nullif("a.year", F.lit(0)).alias("year"), F.col("a.tag").alias("source"), "edge_type", F.explode(right).alias("b")).withColumn("target", F.col("b.tag"))
    # one row for each edge and paper first: a distinct count then needs no expansion, and no list where none is asked for
    key = ["source", "target", "edge_type"]
    each = both.groupBy(*key, "paper_uid").agg(F.count("*").alias("n"), F.min("year").alias("lo"), F.max("year").alias("hi"))
    listed = [F.array_sort(F.collect_list("paper_uid")).alias("witness_papers")] if witnesses else []
    return each.groupBy(*key).agg(
        F.sum("n").alias("co_occurrence_count"), *listed, F.min("lo").alias("first_year"), F.max("hi").alias("last_year"), F.count("paper_uid").alias("witness_paper_count")
    )


def build_cooccurrence(edges: Edges, ontology_edges: DataFrame, ontology: DataFrame, papers: DataFrame, colon_ids: bool = True, legs: set[str] | None = None, pairs: list[tuple[str, str, str]] = PAIRS) -> DataFrame:
    """LIKELY_* edges.  Contexts take the legs alone that can reach an allowed type."""
    used = {t for p in pairs for t in p[:2]}
    members = contexts(edges, legs or {LEG_OF[t] for t in used}, colon_ids)
    types = ontology.where(F.col("ontology_type").isin(sorted(used))).select(F.col("uid").alias("tag"), F.col("ontology_type").alias("type"))
    tagged = ontology_edges.select(F.col("source").alias("member"), F.col("target").alias("tag")).distinct().join(types, "tag")
    tags = members.join(tagged, "member").select("ctx", "paper_uid", "tag", "type").distinct()
    years = papers.select(F.col("uid").alias("paper_uid"), "year")
    return pair_up(tags.join(years, "paper_uid", "left"), pairs)


def build_lifted(edges: Edges, family_edges: DataFrame, template_edges: DataFrame) -> DataFrame:
    """TESTED_IN_TEMPLATE edges between families and templates of tested pairs, with witnesses."""
    tested = _of(edges, "TESTED_IN").select(F.col("source").alias("cat"), F.col("target").alias("rxn"), "paper_uid")
    fam = family_edges.select(F.col("source").alias("cat"), F.col("target").alias("source"))
    tmpl = template_edges.select(F.col("source").alias("rxn"), F.col("target").alias("target"))
    both = tested.join(fam, "cat").join(tmpl, "rxn")
    out = both.groupBy("source", "target").agg(F.count("*").alias("witness_count"), F.array_sort(F.collect_set("paper_uid")).alias("witness_papers"))
    return out.withColumns({"edge_type": F.lit("TESTED_IN_TEMPLATE"), "witness_paper_count": F.size("witness_papers").cast("bigint")})


def template_similarity(templates: DataFrame, least: float = 0.3) -> DataFrame:
    """SIMILAR_TO edges: equal domain, and equal class or reactants that overlap by more than ``least``.

    Candidates come from two equi-joins, on domain and class and on domain and a shared reactant,
    so a large domain is not paired with itself.
    """
    low = F.array_distinct(F.transform(F.filter(list_or_empty("reactants"), lambda r: r != ""), lambda r: strip(F.lower(r))))
    t = templates.select("uid", "ord", F.col("reaction_domain").alias("dom"), F.coalesce("reaction_class", F.lit("")).alias("cls"), low.alias("rs")).where("dom <> ''")
    each = t.withColumn("r", F.explode("rs"))
    side = lambda df, n, keys: df.select(*keys, *[F.col(c).alias(f"{c}{n}") for c in ("uid", "ord", "cls", "rs")])
    found = []
    for df, keys in ((t.where("cls <> ''").withColumn("k", F.col("cls")), ["dom", "k"]), (each, ["dom", "r"])):
        found.append(side(df, "a", keys).join(side(df, "b", keys), keys).where("orda < ordb").drop(*keys))
    pairs = found[0].unionByName(found[1]).dropDuplicates(["uida", "uidb"])
    shared, whole = F.size(F.array_intersect("rsa", "rsb")), F.greatest(F.size(F.array_union("rsa", "rsb")), F.lit(1))
    jac = shared / whole
    same = (F.col("clsa") == F.col("clsb")) & (F.col("clsa") != "")
    basis = F.array_compact(F.array(F.lit("domain"), F.when(same, "class"), F.when(jac > 0, F.concat(F.lit("reactant_jaccard="), two_decimals(jac)))))
    kept = pairs.where(same | (jac > least))
    return kept.select(F.col("uida").alias("source"), F.col("uidb").alias("target"), F.lit("SIMILAR_TO").alias("edge_type"), basis.alias("similarity_basis"))


def family_similarity(families: DataFrame) -> DataFrame:
    """SIMILAR_TO edges between families that share a dominant platform which is not a common one."""
    common = F.array(*[F.lit(c) for c in COMMON_PLATFORMS])
    f = families.select("uid", "ord", F.explode(F.array_except(list_or_empty("dominant_material_platform"), common)).alias("p"), list_or_empty("dominant_active_site_form").alias("sites"))
    side = lambda n: f.select("p", *[F.col(c).alias(f"{c}{n}") for c in ("uid", "ord", "sites")])
    pairs = side("a").join(side("b"), "p").where("orda < ordb").dropDuplicates(["uida", "uidb"])
    basis = F.when(F.arrays_overlap("sitesa", "sitesb"), F.array(F.lit("material_platform"), F.lit("active_site_form"))).otherwise(F.array(F.lit("specific_material_platform")))
    return pairs.select(F.col("uida").alias("source"), F.col("uidb").alias("target"), F.lit("SIMILAR_TO").alias("edge_type"), basis.alias("similarity_basis"))
