"""Layers that grow by batches: each keeps one row for a key, merged from the batches' own rows.

A layer's rows lie in buckets by a hash of their key.  A batch reads and rewrites only the buckets that its keys fall
into, under a folder of its own, and one small table, written last, says which folder each bucket of each layer is read
from.  So a batch changes all layers or none, one that failed half-way is run again over its leftovers, and one that
has been committed does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import list_or_empty
from ..operators import bridge, canonical
from ..sources.io import exists, staged

BUCKETS = 64


@dataclass(frozen=True)
class MergedLayer:
    """``combine`` makes one row of those that share the key; its result can be combined with further rows."""

    name: str
    key: tuple[str, ...]
    combine: Callable[[DataFrame], DataFrame]


def _cooccurrence(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("co_occurrence_count", "witness_paper_count")]
    return rows.groupBy("source", "target", "edge_type").agg(*sums, F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"))


def _clusters(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.min("ord").alias("ord"), F.min_by("rep", "ord").alias("rep"), F.sum("instance_count").alias("instance_count"))


def _labels(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "field", "label").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def _papers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("paper_uid").agg(F.min("ord").alias("ord"))


PAPERS = MergedLayer("papers", ("paper_uid",), _papers)
COOCCURRENCE = MergedLayer("cooccurrence", ("source", "target", "edge_type"), _cooccurrence)
TEMPLATES = MergedLayer("templates", ("key",), _clusters)
FAMILIES = MergedLayer("families", ("key",), _clusters)
LABELS = MergedLayer("labels", ("key", "field", "label"), _labels)


class LayerStore:
    """Merged layers under a path that driver and executors share.  One batch is committed at a time."""

    def __init__(self, spark: SparkSession, path: str, layers: list[MergedLayer], buckets: int = BUCKETS):
        self.spark, self.path, self.buckets, self.layers = spark, path, buckets, {m.name: m for m in layers}

    def committed(self, batch: int) -> bool:
        return exists(self.spark, f"{self.path}/commits/batch={batch}/_SUCCESS")

    def _folders(self, name: str) -> dict[int, list[int]]:
        """The buckets that are read from each batch's folder; at most a row for each bucket is collected."""
        if not exists(self.spark, f"{self.path}/commits"):
            return {}
        log = self.spark.read.schema("layer string, bucket int, batch int").parquet(f"{self.path}/commits")
        log = log.where((F.col("layer") == name) & F.col("batch").isin(self._batches()))
        out: dict[int, list[int]] = {}
        for r in log.groupBy("bucket").agg(F.max("batch").alias("batch")).collect():
            out.setdefault(r["batch"], []).append(r["bucket"])
        return out

    def _batches(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        found = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)
        batches = [int(f.getPath().getName().partition("=")[2]) for f in found if f.getPath().getName().startswith("batch=")]
        return [b for b in batches if self.committed(b)]

    def read(self, name: str, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of a layer, of some buckets or all; none before its first rows."""
        parts = []
        for batch, own in sorted(self._folders(name).items()):
            wanted = [b for b in own if buckets is None or b in buckets]
            if wanted:
                parts.append(self.spark.read.parquet(f"{self.path}/{name}/batch={batch}").where(F.col("bucket").isin(wanted)).drop("bucket"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _bucketed(self, layer: MergedLayer, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*layer.key), F.lit(self.buckets)).cast("int"))

    def lacking(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows whose key the layer has not, by its touched buckets alone."""
        layer = self.layers[name]
        touched = [r[0] for r in self._bucketed(layer, rows).select("bucket").distinct().collect()]
        known = self.read(name, touched)
        return rows if known is None else rows.join(known.select(*layer.key), list(layer.key), "left_anti")

    def commit(self, batch: int, partials: dict[str, DataFrame]) -> list[dict]:
        """Merges a batch's rows into its layers; batches' numbers ascend.  Returns the buckets touched and the rows read from them for each layer."""
        if self.committed(batch):
            return []
        if exists(self.spark, f"{self.path}/commits") and max(self._batches(), default=-1) > batch:
            raise ValueError(f"batch {batch} comes after a later one")
        spark, done, log = self.spark, [], []
        for name, rows in partials.items():
            layer = self.layers[name]
            new = staged(self._bucketed(layer, layer.combine(rows)), f"batch-{name}")
            touched = sorted(r[0] for r in new.select("bucket").distinct().collect())
            old, had = self.read(name, touched), 0
            merged = new.drop("bucket")
            if old is not None:
                had = old.count()
                merged = layer.combine(old.unionByName(merged))
            self._bucketed(layer, merged).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch={batch}")
            done.append({"layer": name, "buckets": len(touched), "rows_read": had})
            log += [(name, b) for b in touched]
        marks = spark.createDataFrame(log, "layer string, bucket int").coalesce(1)
        marks.write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        return done


def label_counts(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, label, n, first) of list columns, as LABELS keeps them; ``rows`` have ``ord``."""
    each = [rows.select(F.col(key).alias("key"), F.lit(f).alias("field"), "ord", F.posexplode(list_or_empty(f)).alias("pos", "label")) for f in fields]
    return reduce(DataFrame.unionByName, each).where("label <> ''").groupBy("key", "field", "label").agg(F.count("*").alias("n"), F.min(F.struct("ord", "pos")).alias("first"))


def dominant_labels(labels: DataFrame, n: int = 3) -> DataFrame:
    """(key, field, labels): the most frequent labels, ties by their first occurrence."""
    rank = F.row_number().over(Window.partitionBy("key", "field").orderBy(F.desc("n"), "first"))
    top = labels.withColumn("rank", rank).where(F.col("rank") <= n).groupBy("key", "field").agg(F.array_sort(F.collect_list(F.struct("rank", "label"))).alias("top"))
    return top.select("key", "field", F.transform("top", lambda x: x["label"]).alias("labels"))


def add_papers(store: LayerStore, batch: int, layer, ontology_edges: DataFrame, ontology: DataFrame) -> list[dict]:
    """Adds the instance layer of new papers to the canonical and co-occurrence layers of a store.

    A paper counts once: papers of earlier batches add nothing.  Witness counts add up because batches share no paper.
    """
    papers = staged(store.lacking("papers", layer.nodes["Paper"].select(F.col("uid").alias("paper_uid"), "ord")), "new-papers")
    own = lambda df: df.join(papers.select("paper_uid"), "paper_uid", "left_semi")
    edges = {kind: own(e) for kind, e in layer.edge_tables.items()}
    likely = bridge.build_cooccurrence(edges, ontology_edges, ontology, layer.nodes["Paper"]).drop("witness_papers")
    reactions = own(layer.nodes["Reaction"]).withColumn("key", canonical.merge_key())
    carried = ["reaction_name_reported", "transformation", "reaction_domain", "reaction_class", "reaction_family", "reactants", "target_products"]
    templates = reactions.select("key", "ord", F.struct(*carried).alias("rep"), F.lit(1).cast("long").alias("instance_count"))
    catalysts = canonical.catalyst_names(own(layer.nodes["Catalyst"]))
    families = catalysts.select(F.col("canonical").alias("key"), "ord", F.struct(F.col("member_name").alias("name")).alias("rep"), F.lit(1).cast("long").alias("instance_count"))
    labels = label_counts(catalysts, "canonical", ["labels_material_platform", "labels_active_site_form"])
    done = store.commit(batch, {"papers": papers, "cooccurrence": likely, "templates": templates, "families": families, "labels": labels})
    catalysts.unpersist()
    return done
