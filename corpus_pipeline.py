"""The corpus pipeline: five stages over ``documents``, each written and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import decontam, langid, lines, pieces, simhash
from tesserae.llm.common import load, shared_dir

KEEP: list[str] = []  # languages that stay; empty: every learned one
KEPT_PARTS = 60_000  # by a task of the last stage in each generation; executors hold memory of the earlier stages
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the language that they are written in as ``lang``; those without one go.

    Profiles are learned from the rows that declare a language.  The prediction replaces the declared language, which
    may be null or wrong; texts that are null or have no letter, and those in none of KEEP (all languages, if it is
    empty), are rejected.  If no row declares a language, nothing can be predicted and all go.
    """
    found = langid.identify(docs.select(*COLUMNS), langid.train(docs))
    kept = found.where(F.col("lang_pred").isin(KEEP) if KEEP else F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicate lines go, but for the earliest; ``n_chars`` follows.  Documents without a visible line left go."""
    return lines.dedup_lines(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id stays; rows without an id stay."""
    groups = simhash.near_duplicates(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go, whole."""
    gone = decontam.leaks(docs, load(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text by the two best segmentations, with the proof of the round trip; null texts have none."""
    return pieces.encode_documents(docs, pieces.Vocabulary.read(pieces.MODEL), cache=KEPT_PARTS)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]
#: SQL expresses none of: learned profiles, fingerprint bits over long texts, edit matching, lattices.  Each stage is
#: tested against a plain version of its operator, and the stages' decisions and edges in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each stage's rows are written to the shared folder."""
    docs, top = load(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{top}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
