"""The import job over a growing directory: the batch operators run on each micro-batch unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docspark.plans.jobs import import_docs
from docspark.sources.ndjson import documents_of_lines


def ndjson_stream(spark: SparkSession, path: str, uri_id: str, **uri_options) -> DataFrame:
    """Documents of newline-delimited JSON files, as they appear below ``path``."""
    lines = spark.readStream.text(path).select(
        "value", F.col("_metadata.file_path").alias("src_id"), F.col("_metadata.file_block_start").alias("block")
    )
    return documents_of_lines(lines, uri_id, **uri_options)


def import_stream(
    docs: DataFrame, store: str, checkpoint: str, rejects: str | None = None, once: bool = True, **metadata
) -> StreamingQuery:
    """Import a stream of documents. A micro-batch that is repeated after a failure is known by the checkpoint and its number:
    it gives one load and its rejects once. ``once`` stops when nothing is left."""

    def load(batch: DataFrame, batch_id: int) -> None:
        import_docs(batch, store, rejects, load_id=(checkpoint, batch_id), **metadata)

    writer = docs.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
