"""Small path checks on whatever file system a path belongs to."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def has_files(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.listStatusIterator(p).hasNext()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def full_path(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def matches(spark: SparkSession, path: str) -> list[str]:
    """Full paths of what a path or glob names; none if there is nothing."""
    fs, p = _fs(spark, path)
    if not re.search(r"[{}\[\]*?\\]", path):
        return [fs.makeQualified(p).toString()] if fs.exists(p) else []
    return [fs.makeQualified(s.getPath()).toString() for s in fs.globStatus(p) or []]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole; its name must be new."""
    fs, p = _fs(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(temporary, p):
        fs.delete(temporary, False)
        raise FileExistsError(path)
