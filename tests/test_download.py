"""Downloads through every step of the cascade, and the command line, with a getter that reads a table of answers."""

from __future__ import annotations

import json
import unicodedata

import pytest

from tesserae import __main__ as command
from tesserae.functions import text
from tesserae.operators import download

from .test_graph import FX1
from .test_services import fetch_page  # noqa: F401  (the search of the command line calls it by name)

PDF = b"%PDF-1.7 "
PLACES = {"best_oa_location": {"url_for_pdf": "http://known/b.pdf", "url": None}, "oa_locations": []}
ANSWERS = {
    "http://own/a.pdf": (200, PDF + b"a"),
    "http://own/page": (200, b"<html>"),
    "http://own/gone": (404, b""),
    "http://places/10.1/b": (200, json.dumps(PLACES).encode()),
    "http://known/b.pdf": (200, PDF + b"b"),
    "http://places/10.1/d": (200, b"not json"),
    "http://own/z.pdf": (200, PDF + b"z"),
    "http://record/10.1/a": (200, json.dumps({"title": "Alpha", "year": 2001, "authors": [{"name": "A Ames"}], "openAccessPdf": {"url": "http://own/a.pdf"}}).encode()),
    "http://work/10.1/b": (200, json.dumps({"message": {"title": ["Beta"], "author": [{"given": "B", "family": "Bond"}]}}).encode()),
}


def get(url):
    return ANSWERS.get(url, (404, b""))


def _records(spark, rows):
    return spark.createDataFrame(rows, "ord long, doi string, title string, authors array<string>, year int, oa_pdf_url string, extra string")


def test_cascade(spark, tmp_path):
    """Own link, looked-up link, no PDF, nothing; equal names; null columns; a second run skips what is there and tries the rest again."""
    rows = [
        (0, "10.1/a", "Alpha", ["A Ames"], 2001, "http://own/a.pdf", "x"),
        (1, "10.1/b", "Beta", ["B Bond"], 2002, "http://own/page", None),
        (2, "10.1/c", "Gamma", ["C Cole"], 2003, "http://own/gone", None),
        (3, "10.1/d", "Delta", ["D Dunn"], 2004, None, None),
        (4, None, None, None, None, None, None),
        (5, None, None, None, None, "http://own/z.pdf", None),
        (6, None, None, None, None, "http://own/a.pdf", None),
        (7, "10.1/a", "Alpha", ["A Ames"], 2001, "http://own/a.pdf", "y"),
        (None, "10.1/a", "Lost", ["A Ames"], 2001, "http://own/a.pdf", None),
    ]
    out = str(tmp_path / "files")
    tell = lambda df: {r["ord"]: (r["download_status"], r["download_source"]) for r in df.collect()}
    want = {0: ("success", "open_link"), 1: ("success", "lookup"), 2: ("failed", None), 3: ("failed", None), 4: ("failed", None), 5: ("success", "open_link"), 6: ("skipped_exists", "local"), 7: ("skipped_exists", "local")}
    assert tell(download.download(_records(spark, rows), out, get, "http://places/{doi}", tasks=2)) == want
    files = {p.name: p.read_bytes() for p in (tmp_path / "files").glob("*.pdf")}
    assert files == {"2001_Ames_Alpha.pdf": PDF + b"a", "2002_Bond_Beta.pdf": PDF + b"b", "None_Unknown_.pdf": PDF + b"z"}
    again = tell(download.download(_records(spark, rows), out, get, None, tasks=2))
    assert {k for k, v in again.items() if v[0] == "failed"} == {2, 3} and again[4] == ("skipped_exists", "local")
    assert download.download(_records(spark, rows[:0]), str(tmp_path / "none"), get).count() == 0


def test_requests_keep_a_gap(spark, tmp_path):
    """All tasks together send no more than one request a gap; one answer is asked for once."""
    log = tmp_path / "log"

    def slow(url):
        import time

        with open(log, "a") as to:
            to.write(f"{time.time()}\n")
        return 200, b"x"

    links = spark.createDataFrame([(i, f"u{i}") for i in range(8)], "ord long, url string")
    assert download.answers(links, "ord", slow, tasks=2, gap=0.1).count() == 8
    times = sorted(map(float, log.read_text().split()))
    assert len(times) == 8 and times[-1] - times[0] >= 0.5  # four a task, a fifth of a second apart


def test_slug_folds_every_letter(spark):
    """All characters against their canonical decomposition."""
    chars = [chr(c) for c in range(160, 0x2FA20) if not 0xD800 <= c < 0xE000]
    parts = ["".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]
    df = spark.createDataFrame(list(enumerate(parts)), "k long, t string")
    got = {r["k"]: r["s"] for r in df.select("k", text.slug("t").alias("s")).collect()}
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if c.isascii() and c.isalnum())
    assert got == {k: plain(p) for k, p in enumerate(parts)}


def test_commands(spark, tmp_path):
    at = str(tmp_path)
    assert command.main(["search", "-q", "x", "-n", "7", "--fetcher", f"{__name__}:fetch_page", "-o", at], spark) == {"records": 7}
    assert [command.in_years(spark.createDataFrame([(y,) for y in (1999, 2005, None)], "year int"), y).count() for y in (None, "2000-", "-2000", "1999", "1999-2005")] == [3, 1, 1, 1, 2]
    got = command.main(["download", "-i", f"{at}/search_results", "-o", f"{at}/one", "--get", f"{__name__}:get", "--tasks", "2", "--gap", "0"], spark)
    assert got == {"total": 7, "downloaded": 0, "failed": 7, "skipped": 0}
    dois = ["from-dois", "--dois", "10.1/a, 10.1/b,,10.1/a,10.1/q", "--primary", "http://record/{doi}", "--metadata", "http://work/{doi}", "--lookup", "http://places/{doi}"]
    got = command.main([*dois, "-o", f"{at}/two", "--get", f"{__name__}:get", "--tasks", "2", "--gap", "0"], spark)
    assert got == {"total": 3, "downloaded": 2, "failed": 1, "skipped": 0}
    assert json.loads((tmp_path / "two/index.json").read_text())["stats"] == got
    assert [r["title"] for r in spark.read.json(f"{at}/two/index").orderBy("ord").collect()] == ["Alpha", "Beta", "Unknown (10.1/q)"]
    assert sum("[success]" in r[0] for r in spark.read.text(f"{at}/two/report").collect()) == 2
    papers = tmp_path / "papers.jsonl"
    papers.write_text("\n".join(map(json.dumps, FX1)) + "\n")
    summary = command.main(["run", "--input", str(papers), "--outdir", f"{at}/graph", "--skip-llm-reactions", "--skip-llm-catalysts", "--shard-size", "1"], spark)
    assert command.main(["run", "--outdir", f"{at}/graph", "--viz-only"], spark) == summary
    with pytest.raises(SystemExit):
        command.main(["run", "--unknown"], spark)
    with pytest.raises(SystemExit):
        command.main(["run", "--outdir", at], spark)
