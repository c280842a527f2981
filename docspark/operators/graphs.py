"""Triple packing and graph rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.rdf import graph_collections, resolve_graph, triple_to_xml, triples_document
from docspark.runtime import with_positions
from docspark.schema import to_docs

TRIPLES_PER_DOC = 100


def assign_graph(triples: DataFrame, **options) -> DataFrame:
    """Set ``graph`` by the graph rules (see ``functions.rdf.resolve_graph``)."""
    return triples.withColumn("graph", resolve_graph(F.col("graph"), **options))


def union_graphs(triples: DataFrame, graph: str) -> DataFrame:
    """All quads as triples of one graph."""
    return triples.withColumn("graph", F.lit(graph))


def distinct_graphs(triples: DataFrame) -> DataFrame:
    return triples.select("graph").distinct()


def pack(rows: DataFrame, item: Column, order: list[str], group: list[str], size: int = TRIPLES_PER_DOC) -> DataFrame:
    """Items of a group in arrays of at most ``size``, by rank; a hot group is ranked by many tasks."""
    ranked = with_positions(rows.select(*group, *order, item.alias("_item")), order, group, "_rank")
    part = F.floor((F.col("_rank") - 1) / size).cast("bigint")
    packed = ranked.groupBy(*group, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_item"))).alias("_e"), F.count(F.lit(1)).alias("n")
    )
    return packed.select(*group, "part", "n", F.transform("_e", lambda e: e["_item"]).alias("items"))


def pack_triples(
    triples: DataFrame,
    order: list[str] = ("src_id", "sub_id", "line", "s", "p", "o"),
    size: int = TRIPLES_PER_DOC,
    base_uri: str = "/triplestore/",
    collections: list[str] | None = None,
) -> DataFrame:
    """Documents of at most ``size`` triples, each of one graph, which is also their collection."""
    xml = triple_to_xml(*[F.col(c) for c in ("s", "p", "o", "o_type", "datatype", "lang")])
    packed = pack(triples, xml, list(order), ["graph"], size)
    graph, number = F.lower(F.hex(F.xxhash64("graph"))), (F.col("part") + 1).cast("string")
    uri = F.concat(F.lit(base_uri), graph, F.lit("-"), number, F.lit(".xml"))
    return to_docs(
        packed,
        uri=uri,
        content_type=F.lit("XML"),
        text=triples_document(F.col("items")),
        collections=graph_collections(F.col("graph"), collections),
    )
