"""Readers and writers: JSON Lines documents, graph tables, normalisation queues and results, reports."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import CORRUPT, paper_schema


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that Spark reads it from."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; one folder of its own for a session on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    sc = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tesserae-"))
    return sc._jsc.sc().getCheckpointDir().get()


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame with its lineage cut: a table in the shared folder, read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_line_ordinal(lines: DataFrame, name: str = "paper_ord") -> DataFrame:
    """The 0-based ordinal of each line of a text source, in path and file order.

    A split's lines have consecutive monotonically increasing ids, so a count for each split (a few
    hundred bytes each) gives its offset; no global sort is needed.
    """
    tagged = lines.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__m"))
    splits = tagged.groupBy("__f", "__b").agg(F.count("*").alias("__n"), F.min("__m").alias("__lo"))
    offsets = splits.selectExpr("__f", "__b", "__lo", "sum(__n) over (order by __f, __b) - __n as __off")
    out = tagged.join(offsets, ["__f", "__b"])
    return out.withColumn(name, F.col("__off") + F.col("__m") - F.col("__lo")).drop("__f", "__b", "__m", "__n", "__lo", "__off")


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """One row for each JSON line with ``paper_ord``; a malformed line is kept whole in ``_corrupt_record``."""
    lines = with_line_ordinal(spark.read.text(path))
    schema = T.StructType([*paper_schema().fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.trim("value") != "").select("paper_ord", parsed.alias("p")).select("paper_ord", "p.*")


def papers_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Papers from Python objects, by the same parser as files; for tests and small batches."""
    schema = T.StructType([*paper_schema().fields, T.StructField(CORRUPT, T.StringType())])
    data = [(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "paper_ord long, value string")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select("paper_ord", parsed.alias("p")).select("paper_ord", "p.*")


def stage_papers(papers: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Papers written as Parquet once and read back: later scans prune to the nested fields they use."""
    (papers.repartition(partitions) if partitions else papers).write.mode("overwrite").parquet(path)
    return papers.sparkSession.read.parquet(path)


def check_required(papers: DataFrame) -> None:
    """One aggregate over the keys that a document must have; raises with their counts."""
    keys = ["DOI", "task1", "task2", "task3", "task4", "task5"]
    missing = {k: F.count_if(F.col(k).isNull()).alias(k) for k in keys}
    inner = {
        "reaction_id": "exists(task1.reaction_catalog, x -> x.reaction_id is null)",
        "catalyst_id": "exists(task2.catalyst_catalog, x -> x.catalyst_id is null)",
        "procedure_id": "exists(task3.procedure_catalog, x -> x.procedure_id is null)",
    }
    row = papers.agg(*missing.values(), *[F.count_if(F.expr(e)).alias(k) for k, e in inner.items()]).first().asDict()
    bad = {k: n for k, n in row.items() if n}
    if bad:
        raise ValueError(f"documents lack required keys: {bad}")


def read_json_array(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A JSON array file (or JSON Lines) of a fixed schema; an absent path gives an empty table."""
    if not path or not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=not path.endswith("l"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON Lines; columns whose name starts with ``_`` are dropped, arrays are written as they are."""
    keep = [c for c in df.columns if not c.startswith("_")]
    df.select(*[f"`{c}`" for c in keep]).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables written by ``write_graph``."""
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Parquet partitioned by type, so that a reader of one type reads its files alone."""
    nodes.write.mode("overwrite").partitionBy("node_type").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy("edge_type").parquet(f"{path}/edges")


def reaction_queue(reactions: DataFrame) -> DataFrame:
    """The 8 fields that an external normaliser gets for a reaction."""
    return reactions.select("uid", "reaction_name_reported", "reaction_domain", "reaction_class", "reaction_family", "transformation", "reactants", "target_products")


def catalyst_queue(catalysts: DataFrame) -> DataFrame:
    """The 10 fields that an external normaliser gets for a catalyst."""
    return catalysts.select("uid", "name_reported", "aliases", "role", "series_name", "variant_rule", "variant_value", "substrate_or_support", "labels_material_platform", "labels_active_site_form")


def write_queue(queue: DataFrame, path: str) -> None:
    """A work queue as compressed JSON Lines, most of which are field names.

    Such files can't be split by readers, so each has a quarter of a million records at most.
    """
    queue.write.option("compression", "gzip").option("maxRecordsPerFile", 250_000).json(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, through Hadoop's file system so that any store serves."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def write_json_object(spark: SparkSession, path: str, value: dict) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2))


def valid_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, valid): whether each file starts with the PDF mark."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("valid"))
