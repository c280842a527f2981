"""Whole files as documents."""

from __future__ import annotations

import codecs
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.metadata import add_collection, content_type_of
from docspark.functions.uri import file_path_of, filename_of, uri_build, uri_encode, whole_match
from docspark.runtime import pack_small_files, ship
from docspark.schema import to_docs
from docspark.sources.listing import list_below, with_content

# A document must fit one row; larger files are reported, or read by reference.
MAX_BYTES = (2**31 - 1) // 3


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _files(spark: SparkSession, paths, pattern: str | None) -> DataFrame:
    """(path, length) of files; with their content where only Spark opens them, and then all of them are listed on the driver."""
    ship(spark)  # what is listed here is mostly opened in Python tasks
    df, name = list_below(spark, _paths(paths)), uri_encode(filename_of(F.col("path")))
    if df is None:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_paths(paths))
        df, name = pack_small_files(df), F.col("_metadata.file_name")
    return df.where(name.rlike(whole_match(pattern))) if pattern else df


def _contents(files: DataFrame) -> DataFrame:
    return files.select("path", "content") if "content" in files.columns else with_content(files)


def read_contents(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """(path, content) of whole files; empty ones are left out."""
    return _contents(_files(spark, paths, pattern))


def text_lines(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, encoding: str = "UTF-8", **options
) -> DataFrame:
    """(value, src_id, block) of the lines of all files below ``paths`` whose name the regex ``pattern`` matches.

    Files are cut into blocks at line ends and read by many tasks, in the JVM. It is an error if no file matches.
    ``encoding`` is UTF-16 or UTF-32, which Python tasks read, or any charset in which a line ends with the byte of ``\\n``.
    """
    from docspark.sources.wide_text import UNITS, family, read_wide_lines

    charset = "UTF-8" if encoding.upper() == "SYSTEM" else encoding
    name = codecs.lookup(charset).name
    wide = family(name) in UNITS
    if not wide and "\n".encode(name) != b"\n":
        raise ValueError(f"files in {encoding} cannot be cut at line ends: read them whole")
    files = list_files(spark, paths, pattern)
    if files.isEmpty():
        raise FileNotFoundError(f"no file below {_paths(paths)} matches {pattern or 'any name'}")
    if wide:
        return read_wide_lines(files, name, only_lf=options.get("lineSep") == "\n")
    df = spark.read.option("recursiveFileLookup", "true").options(**options).text(_paths(paths))
    if pattern:
        df = df.where(F.col("_metadata.file_name").rlike(whole_match(pattern)))
    value = F.col("value") if codecs.lookup(charset).name == "utf-8" else F.decode(F.col("value").cast("binary"), charset)
    return df.select(
        value.alias("value"), F.col("_metadata.file_path").alias("src_id"), F.col("_metadata.file_block_start").alias("block")
    )


def list_files(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Recursive listing without reading content; names starting with ``_`` or ``.`` are hidden."""
    return _files(spark, paths, pattern).select(
        F.col("path").alias("src_id"), filename_of(F.col("path")).alias("file_name"), F.col("length").alias("bytes_n")
    )


def decode_text(content: Column, encoding: str = "UTF-8") -> Column:
    """Bytes to text. ``SYSTEM`` is the default; an unknown charset is an error, bad UTF-8 is replaced."""
    charset = "UTF-8" if encoding.upper() == "SYSTEM" else encoding
    if codecs.lookup(charset).name == "utf-8":
        return F.make_valid_utf8(content.cast("string"))
    return F.decode(content, charset)


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    doc_type: str = "MIXED",
    encoding: str = "UTF-8",
    filename_as_collection: bool = False,
    **uri_options,
) -> DataFrame:
    """One document per file, URI = file path. Empty files are dropped, too large ones rejected."""
    files = _files(spark, paths, pattern)
    # chosen before the reading, so the content of a rejected file is never loaded
    ok = _contents(files.where((F.col("length") > 0) & (F.col("length") <= MAX_BYTES)))
    large = files.where(F.col("length") > MAX_BYTES).select("path")
    ct = content_type_of(F.col("path")) if doc_type.upper() == "MIXED" else F.lit(doc_type.upper())
    ok = ok.select("path", "content", ct.alias("content_type"))
    is_text = F.col("content_type") != "BINARY"
    uri, reason = uri_build(file_path_of(F.col("path")), **uri_options)
    collections = F.array(filename_of(F.col("path"))) if filename_as_collection else F.expr("array()")
    docs = to_docs(
        ok,
        uri=uri,
        skip_reason=reason,
        text=F.when(is_text, decode_text(F.col("content"), encoding)),
        bytes=F.when(~is_text, F.col("content")),
        src_id="path",
        collections=collections,
    )
    rejected = to_docs(
        large, src_id="path", skip_reason=F.lit("larger than a row can hold: read it by reference")
    )
    return docs.unionByName(rejected)


def read_file_refs(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, **uri_options) -> DataFrame:
    """Documents by reference: no bytes until a sink opens ``src_id``."""
    files = _files(spark, paths, pattern).select("path", "length")
    uri, reason = uri_build(file_path_of(F.col("path")), **uri_options)
    docs = to_docs(files, uri=uri, skip_reason=reason, content_type=F.lit("BINARY"), src_id="path")
    return docs.drop("bytes", "text")


def filename_collection(docs: DataFrame, file: str = "src_id") -> DataFrame:
    """Add the name of the source file as a collection."""
    return docs.withColumn("collections", add_collection(F.col("collections"), [filename_of(F.col(file))]))
