"""Literature records: response parsing, source fallback, download state, index and report.

No network call is made here: a fetcher is a callable that the caller gives.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import list_or_empty, pdf_filename
from ..sources.schema import DOWNLOAD

PENDING, SUCCESS, SKIPPED, FAILED = "pending", "success", "skipped_exists", "failed"
SEARCH_RESPONSE = """paperId string, externalIds struct<DOI: string>, title string, authors array<struct<name: string>>, year int,
abstract string, citationCount int, journal struct<name: string>, isOpenAccess boolean, openAccessPdf struct<url: string>"""
CROSSREF_RESPONSE = """message struct<author: array<struct<given: string, family: string>>, title: array<string>,
`published-print`: struct<`date-parts`: array<array<int>>>, `published-online`: struct<`date-parts`: array<array<int>>>,
`container-title`: array<string>, abstract: string, `is-referenced-by-count`: int>"""
OA_RESPONSE = "best_oa_location struct<url_for_pdf: string, url: string>, oa_locations array<struct<url_for_pdf: string>>"


def get_with_retry(get: Callable[[str], tuple[int, str] | None], url: str, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str] | None:
    """Up to three tries; 429 waits 2, 4, 8 seconds, an error waits one."""
    for attempt in range(3):
        try:
            got = get(url)
        except OSError:
            if attempt == 2:
                return None
            sleep(1)
            continue
        if got and got[0] == 429:
            sleep(2 ** (attempt + 1))
            continue
        return got
    return None


def parse_dois(text: Column) -> Column:
    """The DOIs of a comma or line separated list."""
    return F.filter(F.transform(F.split(text, "[,\n]"), lambda d: F.trim(d)), lambda d: d != "")


def _empty(c: str, value) -> Column:
    return F.coalesce(F.col(c), F.lit(value))


def parse_search(rows: DataFrame, body: str = "body", doi: Column | None = None) -> DataFrame:
    """Download records from search results, one JSON object a row."""
    r = rows.withColumn("r", F.from_json(body, SEARCH_RESPONSE))
    return r.select(
        F.col("r.paperId").alias("paperId"),
        (doi if doi is not None else F.col("r.externalIds.DOI")).alias("doi"),
        _empty("r.title", "").alias("title"),
        F.transform(F.coalesce("r.authors", F.array().cast("array<struct<name:string>>")), lambda a: F.coalesce(a["name"], F.lit(""))).alias("authors"),
        F.col("r.year").alias("year"),
        _empty("r.abstract", "").alias("abstract"),
        _empty("r.citationCount", 0).alias("citation_count"),
        _empty("r.journal.name", "").alias("journal"),
        _empty("r.isOpenAccess", False).alias("is_open_access"),
        F.col("r.openAccessPdf.url").alias("oa_pdf_url"),
        F.lit(PENDING).alias("download_status"),
        F.lit(None).cast("string").alias("download_source"),
        F.lit(None).cast("string").alias("filename"),
    )


def parse_crossref(rows: DataFrame, body: str = "body") -> DataFrame:
    """(doi, title, authors, year, journal, abstract, citation_count) from metadata responses; print year before online."""
    m = rows.withColumn("m", F.from_json(body, CROSSREF_RESPONSE)["message"])
    full = F.transform(F.col("m.author"), lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"])))
    date = F.coalesce(F.col("m.published-print"), F.col("m.published-online"))["date-parts"]
    return m.select(
        "doi",
        F.coalesce(F.get("m.title", F.lit(0)), F.lit("")).alias("title"),
        F.filter(F.coalesce(full, F.array().cast("array<string>")), lambda n: n != "").alias("authors"),
        F.get(F.get(date, F.lit(0)), F.lit(0)).alias("year"),
        F.coalesce(F.get("m.container-title", F.lit(0)), F.lit("")).alias("journal"),
        _empty("m.abstract", "").alias("abstract"),
        _empty("m.is-referenced-by-count", 0).alias("citation_count"),
    )


def oa_link(body: Column) -> Column:
    """The best open-access link if it ends in .pdf, else the first location that has a PDF link."""
    r = F.from_json(body, OA_RESPONSE)
    best = F.coalesce(F.nullif(r["best_oa_location"]["url_for_pdf"], F.lit("")), r["best_oa_location"]["url"])
    other = F.filter(F.coalesce(r["oa_locations"], F.array().cast("array<struct<url_for_pdf:string>>")), lambda x: x["url_for_pdf"] != "")
    return F.when(best.endswith(".pdf"), best).otherwise(F.get(F.transform(other, lambda x: x["url_for_pdf"]), F.lit(0)))


def resolve_dois(dois: DataFrame, primary: DataFrame, crossref: DataFrame) -> DataFrame:
    """A download record for each DOI: the primary source's, else the metadata source's, else an unknown one.

    ``dois`` has (ord, doi); the sources have (doi, body) for the DOIs they know.
    """
    first = parse_search(primary, doi=F.col("doi")).withColumn("__p", F.lit(True))
    second = parse_crossref(crossref).withColumn("__s", F.lit(True))
    out = dois.join(first, "doi", "left").join(second.select("doi", "__s", *[F.col(c).alias(f"__{c}") for c in ("title", "authors", "year", "journal", "abstract", "citation_count")]), "doi", "left")
    unknown = {"title": F.concat(F.lit("Unknown ("), "doi", F.lit(")")), "authors": F.array().cast("array<string>"), "year": F.lit(None).cast("int"), "journal": F.lit(""), "abstract": F.lit(""), "citation_count": F.lit(0)}
    for c, default in unknown.items():
        out = out.withColumn(c, F.when(F.col("__p"), F.col(c)).when(F.col("__s"), F.col(f"__{c}")).otherwise(default))
    out = out.withColumns({"is_open_access": _empty("is_open_access", False), "download_status": F.lit(PENDING)})
    return out.select("ord", *[c.split()[0] for c in DOWNLOAD.replace("\n", " ").split(", ")]).orderBy("ord")


def fetch_each(rows: DataFrame, key: str, url: Callable[[str], str], get: Callable[[str], tuple[int, str] | None], delay: float = 0.0) -> DataFrame:
    """(key, body) of the keys whose answer has status 200, throttled within each task."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k in frame[key]:
                got = get_with_retry(get, url(k))
                if got and got[0] == 200:
                    out.append((k, got[1]))
                time.sleep(delay)
            yield pd.DataFrame(out, columns=[key, "body"])

    return rows.select(key).mapInPandas(work, f"{key} string, body string")


def download_state(records: DataFrame, attempts: DataFrame, existing: DataFrame) -> DataFrame:
    """Records with file name, status and source.

    ``existing`` has the file names that are there; ``attempts`` has (doi, source, rank, ok).  A present
    file is skipped, else the first successful source counts, else the download failed.
    """
    best = attempts.where("ok").groupBy("doi").agg(F.min_by("source", "rank").alias("__source"))
    out = records.withColumn("filename", pdf_filename("year", "authors", "title")).join(best, "doi", "left")
    out = out.join(existing.select("filename").distinct().withColumn("__there", F.lit(True)), "filename", "left")
    status = F.when(F.col("__there"), SKIPPED).when(F.col("__source").isNotNull(), SUCCESS).otherwise(FAILED)
    source = F.when(F.col("__there"), "local").otherwise(F.col("__source"))
    return out.withColumns({"download_status": status, "download_source": source}).drop("__there", "__source")


def download_stats(records: DataFrame) -> DataFrame:
    """One row: total, downloaded, failed, skipped."""
    s = F.col("download_status")
    return records.agg(F.count("*").alias("total"), F.count_if(s == SUCCESS).alias("downloaded"), F.count_if(s == FAILED).alias("failed"), F.count_if(s.startswith("skipped")).alias("skipped"))


def index(records: DataFrame, topic: str, date: str) -> dict:
    """The download index of a topic.  One topic's records, as a search gave them, fit on the driver."""
    rows = [r.asDict(recursive=True) for r in records.collect()]
    return {"topic": topic, "download_date": date, "papers": rows, "stats": download_stats(records).first().asDict()}


def report(made: dict) -> str:
    """The index as Markdown."""
    s = made["stats"]
    out = [f"# Downloads: {made['topic']}", f"\nDate: {made['download_date']}", "\n## Statistics"]
    out += [f"- {k}: {s[k]}" for k in ("total", "downloaded", "failed", "skipped")] + ["\n## Records\n"]
    for n, p in enumerate(made["papers"], 1):
        out += [f"{n}. [{p['download_status']}] **{p['title']}**", f"   - DOI: {p['doi']}", f"   - source: {p['download_source']} | file: {p['filename']}", ""]
    return "\n".join(out)


class SearchSource(DataSource):
    """``spark.read.format("paged_search")``: a paged search.

    Options: query, limit (20), page (100), fetcher (``module:function``, called with query, offset and
    size, gives a list of JSON objects or an object with ``data`` and ``total``), parallel (false), pause
    (seconds between pages, 0).  Pages are asked for one after the other until there are ``limit`` results, a
    page is empty or fails, or the service's total is reached; with ``parallel`` each page is a partition, all
    pages up to the limit are asked for, and a failure raises.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "place int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class _SearchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.query, self.fetcher = options["query"], options["fetcher"]
        self.limit, self.page = int(options.get("limit", 20)), int(options.get("page", 100))
        self.parallel, self.pause = options.get("parallel", "false") == "true", float(options.get("pause", 0))

    def partitions(self) -> list[InputPartition]:
        size = min(self.limit, self.page)
        if not self.parallel:
            return [InputPartition((0, size))]
        return [InputPartition((at, min(size, self.limit - at))) for at in range(0, self.limit, max(size, 1))]

    def read(self, partition: InputPartition):
        import importlib
        import json

        module, _, name = self.fetcher.partition(":")
        fetch, (at, size) = getattr(importlib.import_module(module), name), partition.value
        if self.parallel:
            for n, row in enumerate(_page(fetch(self.query, at, size))[0][:size]):
                yield at + n, json.dumps(row)
            return
        n = 0
        while n < self.limit:
            try:
                rows, total = _page(fetch(self.query, at, size))
            except Exception:  # what came so far counts
                return
            for row in rows[: self.limit - n]:
                yield n, json.dumps(row)
                n += 1
            at += size
            if not rows or (total is not None and total <= at):
                return
            time.sleep(self.pause)


def _page(answer: list | dict) -> tuple[list, int | None]:
    """The results of an answer and the total, if it tells one."""
    return (answer.get("data") or [], answer.get("total", 0)) if isinstance(answer, dict) else (answer, None)


def search(spark: SparkSession, query: str, fetcher: str, limit: int = 20, page: int = 100) -> DataFrame:
    """Download records of a paged search, in the service's order."""
    spark.dataSource.register(SearchSource)
    rows = spark.read.format("paged_search").options(query=query, fetcher=fetcher, limit=str(limit), page=str(page)).load()
    return parse_search(rows.orderBy("place").limit(limit))


__all__ = ["SearchSource", "download_state", "download_stats", "fetch_each", "get_with_retry", "index", "list_or_empty", "oa_link", "parse_crossref", "parse_dois", "parse_search", "report", "resolve_dois", "search"]
