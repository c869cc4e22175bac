"""Structured Streaming: incremental ingest of documents, and de-duplicated event streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import instance, ontology, post
from ..sources.schema import CORRUPT, paper_schema


def stream_papers(spark: SparkSession, path: str) -> DataFrame:
    """Documents from JSON Lines files as they arrive; ``paper_ord`` is the file's time, ``__file`` and ``__block`` where a line was read."""
    schema = T.StructType([*paper_schema().fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.readStream.text(path)
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    where = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    return lines.select(F.unix_millis("_metadata.file_modification_time").alias("paper_ord"), *where, parsed.alias("p")).select("paper_ord", "__file", "__block", "p.*")


def placed(batch: DataFrame) -> DataFrame:
    """A batch with ``paper_ord`` as the place of each line: by time of the file, its path and the line's place in it.

    A split's lines have consecutive monotonically increasing ids, so the lines of each split give its offset.  Up
    to a million lines of files of one millisecond keep apart from those of the next.
    """
    tagged = batch.withColumn("__m", F.monotonically_increasing_id())
    splits = tagged.groupBy("paper_ord", "__file", "__block").agg(F.count("*").alias("__n"), F.min("__m").alias("__lo"))
    offsets = splits.selectExpr("paper_ord", "__file", "__block", "__lo", "sum(__n) over (partition by paper_ord order by __file, __block) - __n as __off")
    out = tagged.join(offsets, ["paper_ord", "__file", "__block"])
    return out.withColumn("paper_ord", F.col("paper_ord") * 1_000_000 + F.col("__off") + F.col("__m") - F.col("__lo")).drop("__file", "__block", "__m", "__n", "__lo", "__off")


def to_table(stream: DataFrame, path: str, checkpoint: str, seconds: int = 300) -> DataFrame:
    """Runs a stream over what is there now into a Parquet table and reads it."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError("the stream did not end in time")
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert(batch: DataFrame, path: str, key: list[str]) -> None:
    """Appends the rows whose key the table at ``path`` lacks; a batch that runs twice adds nothing."""
    from ..sources.io import exists

    spark = batch.sparkSession
    new = batch.dropDuplicates(key)
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select(*key), key, "left_anti")
    new.write.mode("append").parquet(path)


def ingest(papers: DataFrame, out: str, checkpoint: str, also: Callable[[DataFrame, int], None] | None = None):
    """Starts a query that adds each batch's instance and ontology layers to the tables under ``out``."""

    def step(batch: DataFrame, number: int) -> None:
        papers = (placed(batch) if "__file" in batch.columns else batch).persist()
        layer = instance.build_instance_layer(papers)
        onto, onto_edges = ontology.build_ontology_layer(layer.nodes)
        for name, df in {**layer.nodes, "OntologyTerm": onto}.items():
            upsert(df, f"{out}/nodes/{name}", ["uid"])
        upsert(post.union_all(layer.edges, onto_edges), f"{out}/edges", post.EDGE_KEY)
        if also:
            also(batch, number)
        papers.unpersist()

    return papers.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_stream(events: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark; an ``ntz`` time is read in the session's zone."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, by: str, size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts by time window and column, late events within the delay included."""
    stream = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return stream.groupBy(F.window(time, size), by).agg(F.count("*").alias("n"))
