"""Import, export, copy and extract as one call each."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.metadata import (
    PERMISSION_DDL,
    default_quality,
    merge_collections,
    merge_permissions,
    parse_permissions,
)
from docspark.functions.text import content_error
from docspark.functions.uri import uri_build, uri_output_dir
from docspark.operators.filters import reject_split
from docspark.operators.graphs import TRIPLES_PER_DOC, assign_graph, pack_triples
from docspark.operators.joins import anti_new_graphs, left_graph_permissions
from docspark.operators.redact import redact
from docspark.operators.report import load_report
from docspark.runtime import materialize, ship
from docspark.schema import to_docs
from docspark.sinks.export import export_archive, export_files, export_zip
from docspark.sinks.store import full_metadata, is_applied, own_blobs, scan_docs, upsert_docs


def _configured(collections) -> object:
    return F.array(*[F.lit(c) for c in collections]) if collections else F.expr("cast(array() as array<string>)")


def with_output_metadata(
    docs: DataFrame, collections: list[str] | None = None, permissions: str | None = None, quality: int = 0
) -> DataFrame:
    """Merge the job's own collections, permissions and quality into each document."""
    return (
        docs.withColumn("collections", merge_collections(F.col("collections"), _configured(collections)))
        .withColumn(
            "permissions",
            merge_permissions(F.col("permissions"), parse_permissions(F.lit(permissions or "")), F.col("naked")),
        )
        .withColumn("quality", default_quality(F.col("quality"), quality))
    )


def import_docs(
    docs: DataFrame,
    store: str,
    rejects: str | None = None,
    collections: list[str] | None = None,
    permissions: str | None = None,
    quality: int = 0,
    directory: str | None = None,
    load_id: tuple[str, int] | None = None,
    sink: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write the documents of a reader to a store and its rejected records to a table; returns the counters.

    XML and JSON documents that do not parse are rejected, so that paths over the store cannot fail on them.
    The reader's output is written down once: source files are parsed a single time. Documents that the store cannot
    take, as their source is gone or damaged, count as failed and are listed with the rejects, by ``uri``; the others are stored.
    ``load_id`` (job, number of the batch): a batch that is loaded again adds nothing to the store and writes its rejects in
    place of the earlier ones; its counters are 0 if the store holds it. ``sink`` takes the documents in place of the store and
    returns those that it refused, (uri, skip_reason).
    """
    ship(docs.sparkSession)
    docs = to_docs(docs)
    if load_id is not None and sink is None and is_applied(docs.sparkSession, store, load_id):
        return load_report(docs.where("false"))
    docs = docs.withColumn("skip_reason", F.coalesce("skip_reason", content_error(F.col("content_type"), F.col("text"))))
    docs = docs.withColumn("uri", uri_output_dir(F.col("uri"), directory))
    read = materialize(with_output_metadata(docs, collections, permissions, quality), "import")
    good, rejected = reject_split(read)
    if sink is not None:
        failed = materialize(sink(good).select("uri", "skip_reason"), "refused")
    else:
        good, failed = own_blobs(good, store)
    if rejects is not None:
        # named by the batch: a repeated one replaces its rows. They are there before the load counts
        name = f"load={hashlib.md5(load_id[0].encode()).hexdigest()}-{load_id[1]}" if load_id else f"load={uuid.uuid4().hex}"
        listed = rejected.unionByName(failed, allowMissingColumns=True)
        listed.select(*rejected.columns, "uri").write.mode("overwrite").parquet(f"{rejects}/{name}")
    if sink is None:
        upsert_docs(good, store, staged=True, load_id=load_id, owned=True)
    return load_report(read, failed=failed)


def export_docs(spark: SparkSession, store: str, out_dir: str, output: str = "files", rules=(), **scope) -> DataFrame:
    """Write stored documents to files, zips or archives; returns the listing."""
    docs = redact(scan_docs(spark, store, **scope), rules)
    sink = {"files": export_files, "zip": export_zip, "archive": export_archive}[output]
    return sink(docs if output == "files" else full_metadata(docs), out_dir)


# Without a server between, extracting from storage is an export with a scope.
extract_docs = export_docs


def copy_docs(
    spark: SparkSession,
    source: str,
    target: str,
    uri_options: dict | None = None,
    collections: list[str] | None = None,
    permissions: str | None = None,
    quality: int = 0,
    rules=(),
    **scope,
) -> DataFrame:
    """Copy documents from store to store under a scope, with URI rules, metadata switches and redaction.

    ``collections``, ``permissions`` and ``quality`` are added on the way; scope by collection is
    ``in_collections``. Returns the counters.
    """
    if "in_collections" in scope:
        scope["collections"] = scope.pop("in_collections")
    docs = full_metadata(redact(scan_docs(spark, source, **scope), rules))
    uri, reason = uri_build(F.col("uri"), encode=False, **(uri_options or {}))
    docs = docs.withColumn("skip_reason", reason).withColumn("uri", uri)
    return import_docs(docs, target, None, collections, permissions, quality)


def import_triples(
    triples: DataFrame,
    store: str,
    rejects: str | None = None,
    stored_graphs: DataFrame | None = None,
    permissions: str | None = None,
    collections: list[str] | None = None,
    size: int = TRIPLES_PER_DOC,
    **graph_options,
) -> DataFrame:
    """Pack the triples of a reader into documents of one graph each and write them; returns the new graphs.

    ``stored_graphs`` (graph, permissions) are the graphs known already: their documents get the permissions
    stored there, those of new graphs the configured ones.
    """
    spark = triples.sparkSession
    triples = materialize(triples, "triples")
    if rejects is not None:
        bad = triples.where(F.col("skip_reason").isNotNull())
        bad.select("src_id", "sub_id", "line", "skip_reason").write.mode("append").parquet(rejects)
    good = triples.where(F.col("skip_reason").isNull())
    good = assign_graph(good, collections=collections, **graph_options)
    if stored_graphs is None:
        stored_graphs = spark.createDataFrame([], f"graph string, permissions {PERMISSION_DDL}")
    packed = pack_triples(good, size=size, collections=collections)
    docs = packed.drop("permissions").withColumn("graph", F.get("collections", 0))
    docs = left_graph_permissions(docs, stored_graphs, parse_permissions(F.lit(permissions or "")))
    upsert_docs(docs, store)
    return anti_new_graphs(good, stored_graphs)
