"""External normalisation: batches of a work queue sent to a pluggable normaliser, with checks and resume.

A normaliser is a callable that gets the records of one batch (dicts) and returns a list of dicts.
It runs inside ``mapInPandas`` tasks; a failing batch gives no rows and its records fall back to rules.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_text, strip, text_or_empty

Normalizer = Callable[[list[dict]], list[dict]]


@dataclass
class Options:
    """Settings of a normalisation run."""

    batch: int = 20
    concurrency: int = 16
    attempts: int = 3
    backoff: float = 1.0
    fields: dict[str, str] = field(default_factory=dict)


def strip_fence(text: str) -> str:
    """A model's answer without the code fence around it."""
    got = re.search(r"```(?:json)?\s*(.*?)```", text, re.S)
    return (got.group(1) if got else text).strip()


def parse_rows(text: str) -> list[dict]:
    """The objects of a JSON array in an answer; anything else raises."""
    rows = json.loads(strip_fence(text))
    if not isinstance(rows, list):
        raise ValueError("the answer is no JSON array")
    return [r for r in rows if isinstance(r, dict)]


def with_retry(call: Callable[[], list[dict]], attempts: int, backoff: float, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """The call's result, tried again with growing pauses."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if n == attempts:
                raise
            sleep(backoff * n)
    return []


def prompt(rows: list[dict], fields: list[str]) -> str:
    """A batch as numbered text for a model: one line for each field that has a value."""
    out = []
    for n, row in enumerate(rows, 1):
        out.append(f"[{n}] uid: {row['uid']}")
        for f in fields:
            value = row.get(f)
            value = ", ".join(map(str, value)) if isinstance(value, (list, tuple)) else value
            if value not in (None, ""):
                out.append(f"    {f}: {value}")
    return "\n".join(out)


def run_batches(queue: DataFrame, normalizer: Normalizer, schema: str, options: Options | None = None, key: str = "uid") -> DataFrame:
    """The normaliser's rows (``schema``, text fields and lists) for a queue, with ``status`` ok or failed.

    Batches are dealt over ``concurrency`` tasks.  A row counts if its key is in its batch, and
    the first answer for a key wins.  A record without an answer, or of a failed batch, has nulls and its
    status tells why.
    """
    options = options or Options()
    names = [f.split()[0] for f in schema.split(", ")]
    columns = queue.columns

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            records = [{c: (list(v) if hasattr(v, "tolist") else v) for c, v in r.items()} for r in frame[columns].to_dict("records")]
            out = []  # a table for each batch would cost far more than its rows
            for at in range(0, len(records), options.batch):
                rows = records[at : at + options.batch]
                asked, got = [r[key] for r in rows], {}
                try:
                    made, status = with_retry(lambda rows=rows: normalizer(rows), options.attempts, options.backoff), "missing"
                except Exception as error:
                    made, status = [], f"failed: {error}"[:200]
                known = set(asked)
                for m in made:
                    k = m.get(key)
                    if k in known and k not in got:
                        got[k] = m
                out += [[got[k].get(n) if k in got else (k if n == key else None) for n in names] + ["ok" if k in got else status] for k in asked]
            if out:
                yield pd.DataFrame(out, columns=[*names, "status"])

    return queue.repartition(options.concurrency).mapInPandas(work, f"{schema}, status string")


def normalize_reactions(queue: DataFrame, normalizer: Normalizer, options: Options | None = None) -> DataFrame:
    """Results with blank names where none came; the status column tells a failure from a blank answer."""
    schema = "uid string, canonical_reaction_name string, canonical_reaction_aliases array<string>"
    out = run_batches(queue, normalizer, schema, options)
    return out.withColumns({"canonical_reaction_name": strip(text_or_empty("canonical_reaction_name")), "canonical_reaction_aliases": F.coalesce("canonical_reaction_aliases", F.array().cast("array<string>"))})


def normalize_catalysts(queue: DataFrame, normalizer: Normalizer, options: Options | None = None) -> DataFrame:
    """As for reactions; a missing family is the name."""
    schema = "uid string, canonical_catalyst_name string, canonical_catalyst_family string, canonical_aliases array<string>"
    out = run_batches(queue, normalizer, schema, options)
    name = strip(text_or_empty("canonical_catalyst_name"))
    family = first_text(strip(text_or_empty("canonical_catalyst_family")), name)
    out = out.withColumns({"canonical_catalyst_family": family, "canonical_catalyst_name": name, "canonical_aliases": F.coalesce("canonical_aliases", F.array().cast("array<string>"))})
    return out.withColumn("canonical_name", F.col("canonical_catalyst_family"))


def remaining(queue: DataFrame, done: DataFrame, key: str = "uid") -> DataFrame:
    """The records that a checkpoint table of results does not have yet."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def resume(queue: DataFrame, path: str, step: Callable[[DataFrame], DataFrame], schema: str, keep_failed: bool = False, key: str = "uid", flush: int = 2000) -> DataFrame:
    """Runs ``step`` on what the checkpoint at ``path`` lacks, appends its rows there, and returns them all.

    The records go in groups of about ``flush``, dealt by a hash of their key, and each group's rows are committed
    before the next begins: a crash loses the answers of one group.  Failed records stay out of the checkpoint, so
    the next run tries them again.
    """
    from ..sources.io import exists

    spark = queue.sparkSession
    done = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    rest = remaining(queue, done, key)
    groups = max(1, -(-rest.count() // flush))
    for n in range(groups):
        made = step(rest if groups == 1 else rest.where(F.pmod(F.xxhash64(key), F.lit(groups)) == n))
        if not keep_failed and "status" in made.columns:
            made = made.where("status = 'ok'")
        made.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def family_rollup(results: DataFrame, samples: int = 5, order: Column | None = None) -> DataFrame:
    """(family, members_sample, count), largest first, families in order of appearance among equals.

    ``order`` tells the order of appearance; without one it is that in which rows are read.
    """
    family = first_text(strip(text_or_empty("canonical_catalyst_family")), strip(text_or_empty("canonical_name")))
    rows = results.withColumn("__n", F.monotonically_increasing_id() if order is None else order)
    rows = rows.select(family.alias("family"), first_text("canonical_catalyst_name", family).alias("member"), "__n").where("family <> ''")
    first = rows.groupBy("family", "member").agg(F.min("__n").alias("first"), F.count("*").alias("n"))
    picked = first.withColumn("k", F.row_number().over(Window.partitionBy("family").orderBy("first")))
    sample = F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= samples, F.struct("k", "member")))), lambda x: x["member"])
    out = picked.groupBy("family").agg(sample.alias("members_sample"), F.sum("n").alias("count"), F.min("first").alias("__first"))
    return out.orderBy(F.desc("count"), "__first").drop("__first")


def complete_map(families: DataFrame, answers: DataFrame, order: Column | None = None) -> DataFrame:
    """A (family, canonical) row for each family: the first valid answer by ``order`` (without one, as read), else the family itself."""
    ordered = answers.withColumn("__n", F.monotonically_increasing_id() if order is None else order).withColumns({"family": strip(text_or_empty("family")), "canonical": strip(text_or_empty("canonical"))})
    first = ordered.where("family <> '' and canonical <> ''").groupBy("family").agg(F.min_by("canonical", "__n").alias("canonical"))
    return families.select("family").distinct().join(first, "family", "left").withColumn("canonical", F.coalesce("canonical", "family"))


def resolve_map(mapping: DataFrame, depth: int = 51) -> DataFrame:
    """(family, canonical) with chains followed to their end, by at most ``depth`` steps.

    Composing the map with itself doubles the steps, so six joins do; what is over composes the
    binary parts of ``depth``.  A two-cycle ends at the other name after an odd number of steps.
    """
    step = mapping.groupBy("family").agg(F.max("canonical").alias("canonical"))
    total, power = None, step
    while depth:
        if depth & 1:
            total = power if total is None else _compose(total, power)
        depth >>= 1
        if depth:
            power = _compose(power, power)
    return total


def _compose(first: DataFrame, then: DataFrame) -> DataFrame:
    t = then.select(F.col("family").alias("__f"), F.col("canonical").alias("__c"))
    out = first.join(t, F.col("canonical") == F.col("__f"), "left")
    return out.select("family", F.coalesce("__c", "canonical").alias("canonical"))


def rewrite_families(results: DataFrame, mapping: DataFrame) -> DataFrame:
    """Results with their families replaced where the map has them.  Write them to a new table."""
    old = first_text(strip(text_or_empty("canonical_catalyst_family")), strip(text_or_empty("canonical_name")))
    m = mapping.select(F.col("family").alias("__f"), F.col("canonical").alias("__c"))
    out = results.withColumn("__old", old).join(m, F.col("__old") == F.col("__f"), "left")
    new = {c: F.coalesce("__c", F.col(c)) for c in ("canonical_catalyst_family", "canonical_name") if c in results.columns}
    return out.withColumns(new).select(*results.columns)


def map_stats(mapping: DataFrame) -> DataFrame:
    """One row: families, families after the map, and how many changed."""
    return mapping.agg(F.count("*").alias("families"), F.count_distinct("canonical").alias("unique_after"), F.count_if(F.col("family") != F.col("canonical")).alias("merged"))
