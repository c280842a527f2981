"""Joins by URI or graph. Strategy is left to the optimizer; AQE splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.runtime import maybe_broadcast


def join_doc_metadata(docs: DataFrame, meta: DataFrame, key: str = "uri") -> DataFrame:
    """Every document, with its metadata where there is some."""
    return docs.join(meta, key, "left")


def anti_naked(meta: DataFrame, docs: DataFrame, key: str = "uri") -> DataFrame:
    """Metadata without a document."""
    return meta.join(docs.select(key), key, "left_anti")


def semi_existing(ops: DataFrame, docs: DataFrame, key: str = "uri") -> DataFrame:
    """Only operations on documents that exist."""
    return ops.join(docs.select(key), key, "left_semi")


def left_graph_permissions(graphs: DataFrame, stored: DataFrame, defaults: Column) -> DataFrame:
    """Permissions of each graph (graph): the stored ones (graph, permissions), else the defaults."""
    # a flag and not the array itself tells a miss: reading one field of coalesce(array, default) after an
    # outer join loses the default in Spark 4.1
    joined = graphs.join(maybe_broadcast(stored.withColumn("_stored", F.lit(True))), "graph", "left")
    permissions = F.when(F.col("_stored"), F.col("permissions")).otherwise(defaults)
    return joined.withColumn("permissions", permissions).drop("_stored")


def anti_new_graphs(triples: DataFrame, stored_graphs: DataFrame) -> DataFrame:
    """Graphs met in a load that are not stored yet."""
    return triples.select("graph").distinct().join(stored_graphs.select("graph"), "graph", "left_anti")


def broadcast_lookup(df: DataFrame, table: DataFrame, key: str, default: dict[str, object] | None = None) -> DataFrame:
    """Look rows up in a small table; sent to every task only after its size is checked."""
    joined = df.join(maybe_broadcast(table), key, "left")
    return joined.fillna(default) if default else joined
