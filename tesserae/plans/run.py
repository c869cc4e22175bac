"""A full run: documents in, graph, statistics and read models out, with optional external normalisation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import instance, normalize, readmodel, stats
from ..sources import io
from ..sources.schema import CATALYST_RESULT, REACTION_RESULT
from .build import Graph, build_graph, staged


@dataclass
class RunOptions:
    """Where a run reads and writes, and what it skips.

    ``reaction_results`` and ``catalyst_results`` name ready result files; a normaliser makes them
    otherwise, and without either the rules decide.
    """

    input: str
    output: str
    reaction_results: str | None = None
    catalyst_results: str | None = None
    skip_reactions: bool = False
    skip_catalysts: bool = False
    skip_dedup: bool = False
    viewers_only: bool = False
    strict_parity: bool = False
    partitions: int | None = None
    batches: normalize.Options = field(default_factory=normalize.Options)

    @classmethod
    def from_session(cls, spark: SparkSession, **more) -> RunOptions:
        """Options with input and output from ``spark.tesserae.input`` and ``spark.tesserae.output``."""
        found = {k: spark.conf.get(f"spark.tesserae.{k}", "") for k in ("input", "output")}
        return cls(**{**found, **more})


def _results(queue: DataFrame, path: str, schema: str, step, given: str | None) -> DataFrame | None:
    if given:
        return io.read_json_array(queue.sparkSession, given, schema)
    if step is None:
        return None
    return normalize.resume(queue, path, step, schema + ", status string").drop("status")


def merge_families(results: DataFrame, normalizer: normalize.Normalizer, options: normalize.Options, records: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Results with families merged by a normaliser's answers, and the map that was applied.

    ``records`` (uid, ord) tell the place of each result's record, by which families and their sample members are
    ordered; without them results are in the order of reading.
    """
    placed = results if records is None else results.join(records.select("uid", "ord"), "uid", "left")
    rollup = normalize.family_rollup(placed, order=None if records is None else F.struct("ord", "uid")).withColumn("uid", F.col("family"))
    answers = normalize.run_batches(rollup, normalizer, "family string, canonical string", options, key="family")
    mapping = normalize.resolve_map(normalize.complete_map(rollup, answers, order=F.col("canonical")))  # a batch has one answer a family
    return normalize.rewrite_families(results, mapping), mapping


def write_bundles(graph: Graph, path: str) -> None:
    """One JSON line a document, with its nodes and edges."""
    readmodel.paper_bundles(graph.nodes, graph.edges).write.mode("overwrite").json(path)


def write_explorer(graph: Graph, path: str) -> None:
    """The explorer's tables, a folder each."""
    tables = {
        "task_groups": readmodel.task_rollup(graph.edges),
        "co_occur_edges": readmodel.cooccurrence_rows(graph.nodes, graph.edges),
        "paper_titles": readmodel.paper_titles(graph.nodes),
        "edge_samples": readmodel.edge_samples(graph.nodes, graph.edges),
        "summary": readmodel.explorer_summary(graph.nodes, graph.edges),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def run(
    spark: SparkSession,
    options: RunOptions,
    reactions: normalize.Normalizer | None = None,
    catalysts: normalize.Normalizer | None = None,
    families: normalize.Normalizer | None = None,
) -> dict:
    """Builds and writes everything under ``options.output``; returns the statistics.

    The documents and their instance layer are staged as Parquet, the graph is written once, and the read models and
    statistics read it from there.  A second run goes on where normalisation stopped.
    """
    out = options.output.rstrip("/")
    if not options.viewers_only:
        papers = io.read_papers(spark, options.input)
        io.check_required(papers)
        papers = io.stage_papers(papers, f"{out}/papers", options.partitions)
        layer = staged(instance.build_instance_layer(papers), f"{out}/layer")
        rq, cq = io.reaction_queue(layer.nodes["Reaction"]), io.catalyst_queue(layer.nodes["Catalyst"])
        rq.write.mode("overwrite").json(f"{out}/reaction_queue")
        cq.write.mode("overwrite").json(f"{out}/catalyst_queue")
        step = lambda make, with_: (lambda rest: make(rest, with_, options.batches)) if with_ else None
        rr = None if options.skip_reactions else _results(rq, f"{out}/reaction_results", REACTION_RESULT, step(normalize.normalize_reactions, reactions), options.reaction_results)
        cr = None if options.skip_catalysts else _results(cq, f"{out}/catalyst_results", CATALYST_RESULT, step(normalize.normalize_catalysts, catalysts), options.catalyst_results)
        if cr is not None and families is not None and not options.skip_dedup:
            merged, mapping = merge_families(cr, families, options.batches, layer.nodes["Catalyst"])
            mapping.write.mode("overwrite").json(f"{out}/family_map")
            merged.write.mode("overwrite").parquet(f"{out}/catalyst_results_merged")  # the first pass stays as it is
            cr = spark.read.parquet(f"{out}/catalyst_results_merged")
        made = build_graph(papers, rr, cr, strict_parity=options.strict_parity, layer=layer)
        io.write_graph(made.nodes, made.edges, f"{out}/graph")
        made.release()
    nodes, edges = io.read_graph(spark, f"{out}/graph")
    graph = Graph(nodes, edges, {})
    io.write_json_object(spark, f"{out}/stats.json", graph.stats)
    io.write_text(spark, f"{out}/report.txt", stats.report(graph.stats))
    write_bundles(graph, f"{out}/paper_bundles")
    write_explorer(graph, f"{out}/explorer")
    return graph.stats
