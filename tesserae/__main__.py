"""Command line: ``python -m tesserae run | search | download | from-dois``; ``--help`` tells the options of each.

Functions are named ``module:function``: the normalisers of a run (a list of dicts in and out), the page fetcher of a
search (query, offset, size), the getter of the downloads (a URL in, status and bytes out; plain requests by default).
"""

from __future__ import annotations

import argparse
import datetime
import importlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import download, fetch
from .plans import run as runs
from .sources import io
from .sources.schema import DOWNLOAD


def named(text: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, name = text.partition(":")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as error:
        raise argparse.ArgumentTypeError(f"no function {text}: {error}") from error


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tesserae")
    commands = top.add_subparsers(dest="command", required=True)

    r = commands.add_parser("run", help="documents in, graph, statistics and read models out")
    r.add_argument("--input", help="JSON Lines; spark.tesserae.input by default")
    r.add_argument("--outdir", help="folder of the results; spark.tesserae.output by default")
    r.add_argument("--shard-size", type=int, help="documents a partition of the staged documents")
    r.add_argument("--batch", type=int, default=20, help="records in one call of a normaliser")
    r.add_argument("--workers", type=int, default=16, help="tasks that call a normaliser")
    for kind in ("reactions", "catalysts", "families"):
        r.add_argument(f"--{kind}", type=named, help=f"normaliser of the {kind}, module:function")
    for kind in ("reaction", "catalyst"):
        r.add_argument(f"--{kind}-results", help="a result file in place of the normaliser")
    for flag in ("skip-llm-reactions", "skip-llm-catalysts", "skip-dedup"):
        r.add_argument(f"--{flag}", action="store_true")
    r.add_argument("--viz-only", action="store_true", help="only statistics and read models, of a graph that is there")

    s = commands.add_parser("search", help="download records of a paged search, as JSON Lines")
    s.add_argument("--query", "-q", required=True)
    s.add_argument("--limit", "-n", type=int, default=20)
    s.add_argument("--fetcher", required=True, help="module:function")
    s.add_argument("--year-range", help="as 2020-2025; an open end is allowed")
    s.add_argument("--output-dir", "-o", required=True)
    s.add_argument("--output", default="search_results", help="name of the results")

    d = commands.add_parser("download", help="files of a search's records")
    d.add_argument("--input", "-i", required=True, help="results of a search")
    f = commands.add_parser("from-dois", help="files of a list of DOIs")
    given = f.add_mutually_exclusive_group(required=True)
    given.add_argument("--dois", help="separated by commas")
    given.add_argument("--doi-file", help="separated by commas or lines")
    f.add_argument("--primary", required=True, help="URL of a record by {doi}")
    f.add_argument("--metadata", required=True, help="URL of a work's metadata by {doi}, for those without a record")
    for p in (d, f):
        p.add_argument("--output-dir", "-o", required=True)
        p.add_argument("--topic", default="")
        p.add_argument("--get", type=named, default=download.http_get, help="module:function")
        p.add_argument("--lookup", help="URL of open-access locations by {doi}")
        p.add_argument("--tasks", type=int, default=8)
        p.add_argument("--gap", type=float, default=1.1, help="seconds between requests, over all tasks")
    return top


def in_years(records: DataFrame, years: str | None) -> DataFrame:
    """Records of a range of years such as ``2020-2025``, ``2020-``, ``-2025`` or ``2020``."""
    if not years:
        return records
    low, dash, high = years.partition("-")
    return records.where(F.col("year").between(int(low or 0), int((high or 9999) if dash else low)))


def records_of_dois(spark: SparkSession, dois: DataFrame, args: argparse.Namespace) -> DataFrame:
    """Download records of (ord, doi): each DOI once, at its first place."""
    dois = io.staged(dois.groupBy("doi").agg(F.min("ord").alias("ord")).select("ord", "doi"), "dois")

    def bodies(rows: DataFrame, url: str) -> DataFrame:
        links = rows.select("doi", F.replace(F.lit(url), F.lit("{doi}"), F.col("doi")).alias("url"))
        return io.staged(download.answers(links, "doi", args.get, b"", args.tasks, args.gap), "answers").select("doi", F.col("content").cast("string").alias("body"))

    primary = bodies(dois, args.primary)
    return fetch.resolve_dois(dois, primary, bodies(dois.join(primary, "doi", "left_anti"), args.metadata))


def _run(spark: SparkSession, a: argparse.Namespace) -> dict:
    options = runs.RunOptions.from_session(spark)
    options.input, options.output = a.input or options.input, a.outdir or options.output
    if not options.output or not (options.input or a.viz_only):
        raise SystemExit("a run needs an input and a folder for its results")
    if a.shard_size and not a.viz_only:
        options.partitions = max(1, -(-spark.read.text(options.input).count() // a.shard_size))
    options.reaction_results, options.catalyst_results = a.reaction_results, a.catalyst_results
    options.skip_reactions, options.skip_catalysts, options.skip_dedup, options.viewers_only = a.skip_llm_reactions, a.skip_llm_catalysts, a.skip_dedup, a.viz_only
    options.batches.batch, options.batches.concurrency = a.batch, a.workers
    return runs.run(spark, options, a.reactions, a.catalysts, a.families)["summary"]


def _download(spark: SparkSession, a: argparse.Namespace, records: DataFrame) -> dict:
    out = io.staged(download.download(records, f"{a.output_dir}/files", a.get, a.lookup, tasks=a.tasks, gap=a.gap), "downloads")
    topic = a.topic or a.output_dir.rstrip("/").rpartition("/")[2]
    return download.write_index(out, a.output_dir, topic, datetime.date.today().isoformat())


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Runs a command, prints its counts and returns them."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tesserae {args.command}").getOrCreate()
    if args.command == "run":
        counts = _run(spark, args)
    elif args.command == "search":
        found = in_years(fetch.search(spark, args.query, args.fetcher, args.limit), args.year_range)
        path = f"{args.output_dir}/{args.output}"
        io.write_jsonl(found, path)
        counts = {"records": spark.read.text(path).count()}
    elif args.command == "download":
        lines = io.with_line_ordinal(spark.read.text(args.input), "ord")
        records = lines.select("ord", F.from_json("value", DOWNLOAD).alias("r")).select("ord", "r.*")
        counts = _download(spark, args, records)
    else:
        text = spark.createDataFrame([(args.dois,)], "value string") if args.dois else spark.read.text(args.doi_file, wholetext=True)
        dois = text.select(F.posexplode(fetch.parse_dois(F.col("value"))).alias("ord", "doi")).withColumn("ord", F.col("ord").cast("long"))
        counts = _download(spark, args, records_of_dois(spark, dois, args))
    print(counts)
    return counts


if __name__ == "__main__":
    main()
