"""Files of literature records: a file that is there, else the record's own link, else a link that a service knows.

A getter is a callable that the caller gives: ``get(url)`` returns (status, bytes), or None.  Every answer is staged in the
shared folder before the next step reads it, so no file is asked for twice, and the files appear all together.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pdf_filename
from ..sources import files, io
from . import fetch

Get = Callable[[str], tuple[int, bytes] | None]
OWN_LINK, LOOKUP = "open_link", "lookup"


def http_get(url: str, seconds: int = 30) -> tuple[int, bytes]:
    """A plain request; a status that tells an error is returned, other failures raise OSError."""
    try:
        with urllib.request.urlopen(url, timeout=seconds) as answer:
            return answer.status or 200, answer.read()
    except urllib.error.HTTPError as error:
        return error.code, b""


def answers(links: DataFrame, key: str, get: Get, magic: bytes = b"", tasks: int = 8, gap: float = 0.0) -> DataFrame:
    """(key, content) of the ``links`` (key, url) whose answer has status 200 and begins with ``magic``.

    ``tasks`` tasks ask, and each waits ``gap * tasks`` seconds after a request, so together they keep one request a
    ``gap``.  A task holds one answer at a time.
    """
    kind = links.schema[key].dataType.simpleString()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, url in zip(frame[key], frame["url"]):
                got = fetch.get_with_retry(get, url)
                if got and got[0] == 200 and got[1][: len(magic)] == magic:
                    yield pd.DataFrame({key: [k], "content": [got[1]]})
                time.sleep(gap * tasks)

    return links.select(key, "url").repartition(tasks).mapInPandas(work, f"{key} {kind}, content binary")


def attempt(records: DataFrame, get: Get, lookup: str | None, magic: bytes = b"%PDF", tasks: int = 8, gap: float = 0.0) -> DataFrame:
    """(ord, source, content) of the records that have a file: by their own link, else by one that ``lookup`` gives.

    ``lookup`` is a URL with ``{doi}`` in it; its answer names open-access locations.  A DOI is looked up once.
    """
    ask = lambda links, key, first: io.staged(answers(links, key, get, first, tasks, gap), "answers")
    own = ask(records.where("oa_pdf_url <> ''").select("ord", F.col("oa_pdf_url").alias("url")), "ord", magic).withColumn("source", F.lit(OWN_LINK))
    if lookup is None:
        return own
    rest = records.join(own.select("ord"), "ord", "left_anti").where("doi <> ''").select("ord", "doi")
    known = ask(rest.select("doi", F.replace(F.lit(lookup), F.lit("{doi}"), F.col("doi")).alias("url")).distinct(), "doi", b"")
    links = rest.join(known.select("doi", fetch.oa_link(F.col("content").cast("string")).alias("url")).where("url <> ''"), "doi")
    return own.unionByName(ask(links, "ord", magic).withColumn("source", F.lit(LOOKUP)))


def present(spark: SparkSession, path: str) -> DataFrame:
    """(filename) of the files at ``path``; only names are read."""
    if not io.exists(spark, path):
        return spark.createDataFrame([], "filename string")
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("filename"))


def download(records: DataFrame, path: str, get: Get = http_get, lookup: str | None = None, magic: bytes = b"%PDF", tasks: int = 8, gap: float = 0.0) -> DataFrame:
    """``records`` (download records with ``ord``) with file name, status and source; their files are added to ``path``.

    As if the records went one after the other: a file that is there is skipped, and of records with one file name the
    first that has a file writes it, those before it failed, and those after it are skipped.  The first record of each
    name is tried alone; where it has no file, the name's other records are tried together, so a name that very
    many records share (one without author and title, say) is not one task's work.  Records without ``ord`` are dropped.
    Rows that share an ``ord`` count as one and keep one of their values.
    """
    spark = records.sparkSession
    files.register(spark)
    named = records.where("ord is not null").dropDuplicates(["ord"]).withColumn("filename", pdf_filename("year", "authors", "title")).drop("download_status", "download_source")
    rows = io.staged(named, "records")
    there = io.staged(present(spark, path).distinct().withColumn("there", F.lit(True)), "present")
    missing = rows.join(there, "filename", "left_anti")
    first = missing.groupBy("filename").agg(F.min("ord").alias("ord")).select("ord")
    names = rows.select("ord", "filename")
    one = attempt(missing.join(first, "ord", "left_semi"), get, lookup, magic, tasks, gap).join(names, "ord")
    others = missing.join(first, "ord", "left_anti").join(one.select("filename"), "filename", "left_anti")
    both = one.unionByName(attempt(others, get, lookup, magic, tasks, gap).join(names, "ord"))
    won = both.groupBy("filename").agg(F.min(F.struct("ord", "source")).alias("won"))
    kept = both.join(won.select(F.col("won.ord").alias("ord")), "ord", "left_semi")
    kept.select(F.col("ord").alias("ordinal"), F.col("filename").alias("name"), "content").write.format("tesserae_files").mode("append").option("path", path).option("magic", magic.decode()).save()
    out = rows.join(there, "filename", "left").join(won, "filename", "left")
    own = F.col("ord") == F.col("won.ord")
    skipped = F.col("there") | (F.col("ord") > F.col("won.ord"))
    status = F.when(skipped, fetch.SKIPPED).when(own, fetch.SUCCESS).otherwise(fetch.FAILED)
    source = F.when(skipped, "local").when(own, F.col("won.source"))
    return out.withColumns({"download_status": status, "download_source": source}).drop("there", "won")


def write_index(records: DataFrame, path: str, topic: str, date: str) -> dict:
    """The index of a download under ``path``: the records as JSON Lines, the counts as an object, a report as Markdown lines; returns the counts."""
    spark = records.sparkSession
    counts = fetch.download_stats(records).first().asDict()
    io.write_jsonl(records.orderBy("ord"), f"{path}/index")
    io.write_json_object(spark, f"{path}/index.json", {"topic": topic, "download_date": date, "stats": counts})
    head = [f"# Downloads: {topic}", "", f"Date: {date}", "", "## Statistics", *[f"- {k}: {n}" for k, n in counts.items()], "", "## Records"]
    io.write_text(spark, f"{path}/report_head.md", "\n".join(head) + "\n")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    line = F.concat(F.lit("- ["), "download_status", F.lit("] **"), text("title"), F.lit("** DOI: "), text("doi"), F.lit(", source: "), text("download_source"), F.lit(", file: "), "filename")
    records.orderBy("ord").select(line).write.mode("overwrite").text(f"{path}/report")
    return counts
