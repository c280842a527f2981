"""Documents to files, zips and archives. Every task writes what it holds: no shuffle.

A file of a document has one name whoever writes it, so a repeated task writes it again. What goes into an
archive depends on the attempt, so its name does too, and archives of lost attempts are deleted at the end.
"""

from __future__ import annotations

import io
import posixpath
import time
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.metadata import metadata_to_json
from docspark.functions.uri import path_from_uri, uri_output_dir
from docspark.runtime import materialize, ship
from docspark.schema import to_docs
from docspark.sinks.hadoop import full_path
from docspark.sources.archive import METADATA_SUFFIX, NAKED_SUFFIX
from docspark.sources.io import AtomicFile, resolve
from docspark.sources.refs import WHOLE, chunks

ROLL_BYTES = 2**31 - 1
_CHUNK = 1 << 20


def _attempt() -> str:
    t = TaskContext.get()
    return f"{t.partitionId()}-{t.taskAttemptId()}"


def _content(text: Column, data: Column, encoding: str) -> Column:
    return F.when(text.isNotNull(), F.encode(text, encoding)).otherwise(data)


def export_files(docs: DataFrame, out_dir: str, encoding: str = "UTF-8") -> DataFrame:
    """One file per document at the path of its URI. Returns (uri, path, bytes_n, error).

    Documents by reference (a ``ref``, or no text and bytes columns at all) are copied from ``src_id`` as a stream.
    """
    spark = docs.sparkSession
    ship(spark)
    root = full_path(spark, out_dir)
    by_reference = "bytes" not in docs.columns
    path = uri_output_dir(path_from_uri(F.col("uri")), root)
    content = F.lit(None).cast("binary") if by_reference else _content(F.col("text"), F.col("bytes"), encoding)
    ref = F.lit(WHOLE) if by_reference else F.col("ref") if "ref" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("uri", path.alias("path"), content.alias("content"), "src_id", ref.alias("ref"))
    rows = rows.where(F.col("content").isNotNull() | F.col("ref").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = _attempt()
        for pdf in batches:
            sizes, errors = [], []
            for row in pdf.itertuples(index=False):
                n, error = 0, None
                head, _, tail = row.path.partition(root)
                if ".." in tail.split("/") or posixpath.basename(row.path) == "":
                    error = "path leaves the output directory or names no file"
                else:
                    f = AtomicFile(row.path, attempt)
                    if row.content is not None:
                        n = f.stream.write(row.content) or len(row.content)
                    else:
                        for chunk in chunks(row.src_id, row.ref):
                            f.stream.write(chunk)
                            n += len(chunk)
                    f.close()
                sizes.append(n)
                errors.append(error)
            yield pd.DataFrame({"uri": pdf["uri"], "path": pdf["path"], "bytes_n": sizes, "error": errors})

    return materialize(rows.mapInPandas(run, "uri string, path string, bytes_n bigint, error string"), "export-files")


class _Zip:
    """One open archive of a task."""

    def __init__(self, path: str, attempt: str):
        self.path, self.file, self.size, self.entries = path, AtomicFile(path, attempt), 0, 0
        self.zip = zipfile.ZipFile(io.BufferedWriter(_Unseekable(self.file.stream), _CHUNK), "w", zipfile.ZIP_DEFLATED)

    def add(self, name: str, data: bytes | Iterator[bytes]) -> None:
        info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
        info.compress_type = zipfile.ZIP_DEFLATED
        if isinstance(data, bytes):
            self.zip.writestr(info, data)
            self.size += len(data)
        else:
            with self.zip.open(info, "w", force_zip64=True) as entry:
                for chunk in data:
                    entry.write(chunk)
                    self.size += len(chunk)
        self.entries += 1

    def close(self) -> tuple:
        out = self.zip.fp
        self.zip.close()
        out.flush()
        self.file.close()
        return self.path, self.entries, self.size


class _Unseekable(io.RawIOBase):
    """Object stores take bytes in order only."""

    def __init__(self, stream):
        self._stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self._stream.write(bytes(data))
        return len(data)


def _export_zips(docs: DataFrame, out_dir: str, name: Column, metadata: Column, roll_bytes: int, encoding: str) -> DataFrame:
    ship(docs.sparkSession)
    root = full_path(docs.sparkSession, out_dir)
    stamp = f"{time.strftime('%Y%m%d%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:6]}"
    content = F.when(~F.col("naked"), _content(F.col("text"), F.col("bytes"), encoding))
    kind = F.when(F.col("content_type").isin("XML", "JSON", "TEXT"), F.col("content_type")).otherwise("BINARY")
    rows = docs.select(name.alias("name"), kind.alias("kind"), content.alias("content"), metadata.alias("metadata"), "src_id", "ref")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = _attempt()
        zips: dict[str, _Zip] = {}
        rolls: dict[str, int] = {}
        for pdf in batches:
            done = []
            for row in pdf.itertuples(index=False):
                size = len(row.content or b"") + len(row.metadata or "")
                z = zips.get(row.kind)
                # a document and its metadata always share an archive
                if z is not None and z.size and z.size + size > roll_bytes:
                    done.append(zips.pop(row.kind).close())
                    z = None
                if z is None:
                    rolls[row.kind] = rolls.get(row.kind, -1) + 1
                    file = f"{root}/{stamp}-{attempt}-{rolls[row.kind]:06d}-{row.kind}.zip"
                    z = zips[row.kind] = _Zip(file, attempt)
                if row.content is None and row.ref is None:
                    if row.metadata is not None:
                        z.add(row.name + NAKED_SUFFIX, row.metadata.encode())
                    continue
                if row.metadata is not None:
                    z.add(row.name + METADATA_SUFFIX, row.metadata.encode())
                z.add(row.name, row.content if row.ref is None else chunks(row.src_id, row.ref))
            if done:
                yield pd.DataFrame(done, columns=["path", "entries", "bytes_n"])
        if zips:
            yield pd.DataFrame([z.close() for z in zips.values()], columns=["path", "entries", "bytes_n"])

    listing = materialize(rows.mapInPandas(run, "path string, entries bigint, bytes_n bigint"), "export-zip")
    _drop_strays(root, stamp, listing)
    return listing


def _drop_strays(root: str, stamp: str, listing: DataFrame) -> None:
    """Delete archives of attempts that did not count: only those in the committed listing stay."""
    if listing.isEmpty():
        return
    found = listing.sparkSession.read.format("binaryFile").load([f"{root}/{stamp}-*"]).select("path")
    strays = found.join(listing.select("path"), "path", "left_anti")

    def drop(rows: Iterator) -> None:
        for row in rows:
            fs, path = resolve(row.path)
            fs.delete_file(path)

    strays.foreachPartition(drop)


def export_zip(docs: DataFrame, out_dir: str, roll_bytes: int = ROLL_BYTES, encoding: str = "UTF-8") -> DataFrame:
    """Zips of documents, one per task and content type, a new one at ``roll_bytes`` of content; entries are
    named by the path of the URI."""
    with_content = to_docs(docs).where(~F.col("naked"))
    return _export_zips(with_content, out_dir, path_from_uri(F.col("uri")), F.lit(None).cast("string"), roll_bytes, encoding)


def export_archive(docs: DataFrame, out_dir: str, roll_bytes: int = ROLL_BYTES, encoding: str = "UTF-8") -> DataFrame:
    """Zips with a metadata entry before each document; metadata without a document is a ``.naked`` entry."""
    return _export_zips(to_docs(docs), out_dir, F.col("uri"), metadata_to_json(), roll_bytes, encoding)
