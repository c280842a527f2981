"""Zip and gzip containers.

A zip is read in two steps: its directory is listed first, then the entries are spread over tasks by
key, each opened at its own offset. One huge archive is therefore read by many tasks.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.metadata import content_type_of
from docspark.functions.uri import file_path_of, uri_build
from docspark.runtime import materialize, with_positions
from docspark.schema import to_docs
from docspark.sources.files import MAX_BYTES, decode_text, list_files
from docspark.sources.io import open_input, open_stream
from docspark.sources.refs import GZIP, zip_ref

ENTRY_DDL = "src_id string, entry string, offset bigint, csize bigint, usize bigint, method int, encrypted boolean, reason string"
TASK_BYTES = 128 << 20
ENTRY_COST = 4096  # what opening an entry counts beside its bytes
BATCH_BYTES = 16 << 20
_CHUNK = 1 << 20


def _list_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["src_id"]:
            rows = []
            try:
                with open_input(path) as f, zipfile.ZipFile(f) as z:
                    for i in z.infolist():
                        if not i.is_dir():
                            sizes = i.header_offset, i.compress_size, i.file_size, i.compress_type
                            rows.append((path, i.filename, *sizes, bool(i.flag_bits & 1), None))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=_ENTRY_COLUMNS)
                            rows = []
            except (zipfile.BadZipFile, ValueError, struct.error, EOFError) as e:
                rows.append((path, "", 0, 0, 0, 0, False, f"invalid archive: {e}"))
            if rows:
                yield pd.DataFrame(rows, columns=_ENTRY_COLUMNS)


_ENTRY_COLUMNS = [c.split()[0] for c in ENTRY_DDL.split(", ")]


def list_zip_entries(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """One row per archive entry, with what is needed to open it on its own."""
    archives = list_files(spark, paths, pattern).where(F.col("bytes_n") > 0).select("src_id")
    return archives.mapInPandas(_list_batches, ENTRY_DDL)


def spread_entries(entries: DataFrame) -> DataFrame:
    """Spread a listing (src_id, offset, csize) over tasks by volume, in runs of neighbouring entries.

    A task opens few archives and reads each in order; a huge archive is cut over many tasks.
    """
    # written first, so that archives are listed once although a sort reads its input twice
    listed = materialize(entries.withColumn("_cost", F.col("csize") + ENTRY_COST), "entries")
    total = listed.agg(F.coalesce(F.sum("_cost"), F.lit(0))).first()[0]
    placed = with_positions(listed, ["src_id", "offset"], weight="_cost", name="_at")
    parallel = entries.sparkSession.sparkContext.defaultParallelism
    share = max(ENTRY_COST, min(TASK_BYTES, -(-total // parallel)))
    tasks = max(1, -(-total // share))
    task = F.floor((F.col("_at") - 1) / share).cast("int")
    return placed.repartitionById(tasks, task).sortWithinPartitions("src_id", "offset").select(*entries.columns)


def entry_chunks(f, offset: int, csize: int, method: int) -> Iterator[bytes]:
    """Uncompressed bytes of the entry whose local header is at ``offset``."""
    f.seek(offset)
    head = f.read(30)
    name_len, extra_len = struct.unpack("<HH", head[26:30])
    f.seek(offset + 30 + name_len + extra_len)
    inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    left = csize
    while left > 0:
        raw = f.read(min(_CHUNK, left))
        if not raw:
            raise EOFError("archive ends inside an entry")
        left -= len(raw)
        if inflate is None:
            yield raw
            continue
        # a piece of input may unpack to a thousand times its size
        while raw:
            yield inflate.decompress(raw, _CHUNK)
            raw = inflate.unconsumed_tail
    if inflate:
        yield inflate.flush()
        if not inflate.eof:
            raise zlib.error("the packed data of an entry end early")


def entry_problem(row) -> str | None:
    if row.reason:
        return row.reason
    if row.encrypted:
        return "encrypted entry"
    if row.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        return "unsupported compression method"
    return None


def _entry_reader(max_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["src_id", "entry", "content", "ref", "reason"]
        opened, f, rows, size = None, None, [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                content, ref, reason = None, None, entry_problem(row)
                if reason is None and row.usize > max_bytes:
                    ref = zip_ref(row.method, row.offset, row.csize)
                elif reason is None:
                    if row.src_id != opened:
                        f, opened = open_input(row.src_id), row.src_id
                    try:
                        content = b"".join(entry_chunks(f, row.offset, row.csize, row.method))
                    except (zlib.error, EOFError, struct.error) as e:
                        reason = f"invalid entry: {e}"
                rows.append((row.src_id, row.entry, content, ref, reason))
                size += len(content or b"")
                if size >= BATCH_BYTES or len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return run


def read_entries(entries: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(src_id, entry, content, ref, reason) of listed entries; those above ``max_bytes`` come by reference."""
    return spread_entries(entries).mapInPandas(
        _entry_reader(max_bytes), "src_id string, entry string, content binary, ref string, reason string"
    )


def read_zip_docs(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    doc_type: str = "MIXED",
    encoding: str = "UTF-8",
    max_bytes: int = MAX_BYTES,
    **uri_options,
) -> DataFrame:
    """One document per non-empty entry, URI = archive path + ``/`` + entry name.

    Entries above ``max_bytes`` are documents by reference, of any size.
    """
    entries = list_zip_entries(spark, paths, pattern).where((F.col("usize") > 0) | F.col("reason").isNotNull())
    # an entry with an absolute name is its own URI
    raw = F.when(F.col("entry").startswith("/"), F.col("entry")).otherwise(
        F.concat(file_path_of(F.col("src_id")), F.lit("/"), F.col("entry"))
    )
    uri, reason = uri_build(raw, **uri_options)
    ct = content_type_of(F.col("entry")) if doc_type.upper() == "MIXED" else F.lit(doc_type.upper())
    df = read_entries(entries, max_bytes).withColumn("content_type", ct)
    is_text = F.col("content_type") != "BINARY"
    return to_docs(
        df,
        uri=F.when(F.col("reason").isNull(), uri),
        skip_reason=F.coalesce(F.col("reason"), reason),
        text=F.when(is_text, decode_text(F.col("content"), encoding)),
        bytes=F.when(~is_text, F.col("content")),
        sub_id="entry",
    )


def gunzip_chunks(f) -> Iterator[bytes]:
    """Uncompressed bytes of a gzip stream, which may hold several members; an error if it ends inside one."""
    inflate, begun = zlib.decompressobj(31), False
    while raw := f.read(_CHUNK):
        if not begun:
            raw = raw.lstrip(b"\0")  # padding between members
        while raw:
            yield inflate.decompress(raw, _CHUNK)
            raw, begun = inflate.unconsumed_tail, True
            if inflate.eof:
                raw = inflate.unused_data.lstrip(b"\0")
                inflate, begun = zlib.decompressobj(31), False
    if begun:
        raise zlib.error("the file ends inside a member")


def _gunzip_reader(max_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["src_id"]:
                parts, size, ref, reason = [], 0, None, None
                try:
                    with open_stream(path) as f:
                        for chunk in gunzip_chunks(f):
                            parts.append(chunk)
                            size += len(chunk)
                            if size > max_bytes:
                                parts, ref = [], GZIP
                                break
                except zlib.error as e:
                    parts, reason = [], f"invalid gzip: {e}"
                content = b"".join(parts)
                if content or ref or reason:
                    row = {"src_id": [path], "content": [None if ref else content], "ref": [ref], "reason": [reason]}
                    yield pd.DataFrame(row)

    return run


def read_gzip_docs(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    doc_type: str = "MIXED",
    encoding: str = "UTF-8",
    max_bytes: int = MAX_BYTES,
    **uri_options,
) -> DataFrame:
    """One document per gzip file; ``.gz`` or ``.gzip`` is taken off the URI. Above ``max_bytes`` it is one by reference."""
    files = list_files(spark, paths, pattern).select("src_id")
    plain = F.regexp_replace(F.col("src_id"), r"(?i)\.gz(ip)?$", "")
    uri, reason = uri_build(file_path_of(plain), **uri_options)
    ct = content_type_of(plain) if doc_type.upper() == "MIXED" else F.lit(doc_type.upper())
    df = files.mapInPandas(_gunzip_reader(max_bytes), "src_id string, content binary, ref string, reason string").withColumn("content_type", ct)
    is_text = F.col("content_type") != "BINARY"
    return to_docs(
        df,
        uri=F.when(F.col("reason").isNull(), uri),
        skip_reason=F.coalesce(F.col("reason"), reason),
        text=F.when(is_text, decode_text(F.col("content"), encoding)),
        bytes=F.when(~is_text, F.col("content")),
    )


class ChunkReader(io.RawIOBase):
    """File object over an iterator of byte chunks, so that entries stream through text parsers."""

    def __init__(self, chunks: Iterator[bytes]):
        self._chunks, self._left = iter(chunks), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self._left:
            try:
                self._left = next(self._chunks)
            except StopIteration:
                return 0
        n = min(len(buffer), len(self._left))
        buffer[:n], self._left = self._left[:n], self._left[n:]
        return n


def open_file(path: str) -> io.BufferedReader:
    """A file as a stream of bytes; ``.gz`` names are decompressed."""
    f = open_input(path)
    gz = path.lower().endswith((".gz", ".gzip"))
    return io.BufferedReader(ChunkReader(gunzip_chunks(f) if gz else iter(lambda: f.read(_CHUNK), b"")), _CHUNK)


def _size(value) -> int:
    if isinstance(value, str | bytes):
        return len(value)
    return sum(map(_size, value)) if isinstance(value, list) else 0


def stream_records(
    rows: DataFrame, parse: Callable, ddl: str, problem: Callable[[str], tuple] | None = None
) -> DataFrame:
    """Run ``parse(binary stream, src_id, entry)`` over containers or files, batch by batch.

    ``rows`` is a listing: spread zip entries, or files (``src_id``; ``.gz`` names are decompressed).
    ``problem(reason)`` gives the columns to report a container that cannot be read.
    """
    names = ["src_id", "sub_id", *[c.split()[0] for c in ddl.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                entry = getattr(row, "entry", "")
                reason = entry_problem(row) if hasattr(row, "entry") else None
                if reason is None:
                    if hasattr(row, "entry"):
                        chunks = entry_chunks(open_input(row.src_id), row.offset, row.csize, row.method)
                        stream = io.BufferedReader(ChunkReader(chunks), _CHUNK)
                    else:
                        stream = open_file(row.src_id)
                    try:
                        for rec in parse(stream, row.src_id, entry):
                            out.append((row.src_id, entry, *rec))
                            size += 64 + sum(_size(x) for x in rec)
                            if size >= BATCH_BYTES or len(out) >= 20_000:
                                yield pd.DataFrame(out, columns=names)
                                out, size = [], 0
                    except (zlib.error, EOFError, UnicodeDecodeError) as e:
                        reason = f"unreadable: {e}"
                    stream.close()
                if reason is not None and problem is not None:
                    out.append((row.src_id, entry, *problem(reason)))
        if out:
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, "src_id string, sub_id string, " + ddl)


def file_rows(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Files to stream. The scan packs them into tasks by their size; content is opened inside the tasks."""
    return list_files(spark, paths, pattern).where(F.col("bytes_n") > 0).select("src_id")


def entry_rows(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    return spread_entries(list_zip_entries(spark, paths, pattern).where((F.col("usize") > 0) | F.col("reason").isNotNull()))
