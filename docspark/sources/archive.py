"""The engine's own export format: zips named ``*-TYPE.zip`` with a metadata entry before each document."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.metadata import metadata_from_json
from docspark.schema import METADATA_COLUMNS, to_docs
from docspark.sources.files import MAX_BYTES, decode_text
from docspark.sources.io import open_input
from docspark.sources.refs import zip_ref
from docspark.sources.zipped import BATCH_BYTES, entry_chunks, entry_problem, list_zip_entries, spread_entries

METADATA_SUFFIX = ".metadata"
NAKED_SUFFIX = ".naked"
TYPES = ("XML", "JSON", "TEXT", "BINARY")
MISSING = "no metadata entry"
_PAIR_DDL = (
    "src_id string, uri string, content_type string, is_naked boolean, has_content boolean, "
    "content binary, metadata binary, ref string, reason string"
)


def _read_pairs(batches: Iterator[pd.DataFrame], max_bytes: int) -> Iterator[pd.DataFrame]:
    """Content and metadata of each listed document, both from the same archive; large content comes by reference."""
    columns = ["src_id", "uri", "content_type", "is_naked", "has_content", "content", "metadata", "ref", "reason"]
    opened, f, out, size = None, None, [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            parts, ref, reason = {}, None, row.reason
            for part in ("content", "metadata"):
                at = getattr(row, part)
                if at is None or reason is not None:
                    continue
                reason = entry_problem(SimpleNamespace(**at))
                if reason is None and part == "content" and at["usize"] > max_bytes:
                    ref = zip_ref(at["method"], at["offset"], at["csize"])
                elif reason is None:
                    if row.src_id != opened:
                        f, opened = open_input(row.src_id), row.src_id
                    try:
                        parts[part] = b"".join(entry_chunks(f, at["offset"], at["csize"], at["method"]))
                    except (zlib.error, EOFError, struct.error) as e:
                        reason = f"invalid entry: {e}"
            out.append(
                (row.src_id, row.uri, row.content_type, row.is_naked, row.content is not None,
                 parts.get("content"), parts.get("metadata"), ref, reason)
            )
            size += sum(map(len, parts.values()))
            if size >= BATCH_BYTES or len(out) >= 10_000:
                yield pd.DataFrame(out, columns=columns)
                out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=columns)


def read_archive(
    spark: SparkSession, paths: str | Sequence[str], metadata_optional: bool = False, encoding: str = "UTF-8",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Documents with their metadata. Other files are ignored; ``uri.naked`` is metadata without a document;
    a document without metadata is rejected unless ``metadata_optional``.

    Documents above ``max_bytes`` come by reference, of any size. A document meets its metadata by name in the listing, before any content is read, so that only small
    rows are shuffled and both are read by one task.
    """
    entries = list_zip_entries(spark, paths, rf".*-(?:{'|'.join(TYPES)})\.zip")
    is_meta = F.col("entry").endswith(METADATA_SUFFIX) | F.col("entry").endswith(NAKED_SUFFIX)
    at = F.struct("offset", "csize", "usize", "method", "encrypted", F.col("reason"))
    pairs = entries.groupBy(
        "src_id",
        F.regexp_replace("entry", rf"\{METADATA_SUFFIX}$|\{NAKED_SUFFIX}$", "").alias("uri"),
        F.regexp_extract("src_id", r"-([A-Z]+)\.zip$", 1).alias("content_type"),
    ).agg(
        F.max(F.when(~is_meta, at)).alias("content"),
        F.max(F.when(is_meta, at)).alias("metadata"),
        F.bool_or(F.col("entry").endswith(NAKED_SUFFIX)).alias("is_naked"),
        F.max("reason").alias("reason"),
        F.sum("csize").alias("csize"),
        F.min("offset").alias("offset"),
    )
    read = spread_entries(pairs).mapInPandas(lambda batches: _read_pairs(batches, max_bytes), _PAIR_DDL)
    df = read.withColumn("m", metadata_from_json(F.decode("metadata", "UTF-8")))
    df = df.withColumn("has_metadata", F.col("metadata").isNotNull()).drop("metadata")
    missing = ~F.col("has_metadata") & F.lit(not metadata_optional)
    reason = F.coalesce(F.col("reason"), F.when(missing, F.lit(MISSING)))
    is_text = F.col("has_content") & (F.col("content_type") != "BINARY")
    given = {
        c: F.coalesce(F.col(f"m.{c}"), F.expr(d))
        for c, d in zip(METADATA_COLUMNS, ("array()", "array()", "0", "map()", "array()"))
    }
    return to_docs(
        df,
        **given,
        uri=F.when(reason.isNull(), F.col("uri")),
        sub_id="uri",
        text=F.when(is_text, decode_text(F.col("content"), encoding)),
        bytes=F.when(F.col("has_content") & ~is_text, F.col("content")),
        naked=F.col("is_naked") & ~F.col("has_content"),
        skip_reason=reason,
    )
