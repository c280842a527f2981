"""WARC archives of pages, written once per payload, and read back as a table of chunks."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import narrowed
from docspark.runtime import materialize, maybe_broadcast, work_path
from docspark.sources.io import AtomicFile, open_input

#: Bytes of payload in a chunk row, and of file read at a time.
CHUNK, READ = 1 << 20, 1 << 18
#: Bytes of chunks in one batch of rows.
BATCH = 8 << 20
#: Payloads of equal bytes are written once if they have at least so many bytes.
LEAST = 0
#: Longest header block that a reader takes.
HEADERS = 1 << 20

# The profile of a revisit whose payload equals an earlier one, and the date, which pages do not have.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def payload(html: Column) -> Column:
    return F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))


def with_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Add record_type and refers_to: of equal payloads the largest id is the response, the others revisit it.

    Only digests are grouped, with partial counts, so that a payload that a third of all pages share is no hot key;
    the payloads that occur twice are then looked up by the pages, which stay where they are if those are few.
    """
    keyed = pages.withColumn("sha1", F.sha1(payload(F.col("html")))).withColumn("bytes", F.octet_length(payload(F.col("html"))))
    twice = keyed.filter(F.col("bytes") >= least).groupBy("sha1", "bytes").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
    twice = materialize(twice.filter("n > 1").drop("n"), "payloads")
    found = keyed.join(maybe_broadcast(twice), ["sha1", "bytes"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return found.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("largest")))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def base32(sha1: str) -> str:
    """Bare upper-case base32 of a hexadecimal SHA-1."""
    return base64.b32encode(bytes.fromhex(sha1)).decode()


class Writer:
    """A file of records, each a gzip member of its own."""

    def __init__(self, path: str, attempt: str):
        self.file = AtomicFile(path, attempt)
        self.count = 0

    def add(self, page_id: int | None, url: str | None, sha1: str, body: bytes, refers_to: int | None, revisit: bool) -> None:
        kind = b"Content-Type: text/html; charset=utf-8\r\n"
        http = b"HTTP/1.1 200 OK\r\n" + kind + (b"" if revisit else b"Content-Length: %d\r\n" % len(body)) + b"\r\n"
        size = len(http) + (0 if revisit else len(body))
        lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
        if url is not None:
            lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
        lines.append(f"WARC-Payload-Digest: sha1:{base32(sha1)}")
        if revisit:
            lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
        lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}", "", ""]
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        out = self.file.stream
        out.write(packer.compress("\r\n".join(lines).encode() + http))
        if not revisit:
            view = memoryview(body)
            for lo in range(0, len(body), CHUNK):
                out.write(packer.compress(view[lo : lo + CHUNK]))
        out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        self.count += 1


def write_warc(pages: DataFrame, path: str) -> DataFrame:
    """Write (page_id, url, html, sha1, record_type, refers_to) to one file per partition; a row per file: path, records.

    Files get their final name when they are whole; a task that runs again replaces its file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer, file = TaskContext.get(), None, ""
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "sha1", "refers_to", "record_type", "html")]
            for page_id, url, sha1, refers_to, kind, html in zip(*cols, strict=True):
                if writer is None:
                    file = f"{path}/part-{context.partitionId():06d}.warc.gz"
                    writer = Writer(file, f"{context.stageId()}-{context.taskAttemptId()}")
                body = (html.as_py() or "").encode()
                writer.add(page_id.as_py(), url.as_py(), sha1.as_py(), body, refers_to.as_py(), kind.as_py() == "revisit")
        if writer is not None:
            writer.file.close()
            yield pa.RecordBatch.from_pydict({"path": [file], "records": [writer.count]})

    rows = pages.select("page_id", "url", "sha1", "refers_to", "record_type", "html")
    return materialize(rows.mapInArrow(run, "path string, records long"), "warc-files")


class Bytes:
    """The inflated bytes of a file of gzip members, or of a plain one, a piece at a time."""

    def __init__(self, file):
        self.file, self.held, self.done = file, bytearray(), False
        self.plain = file.read(2) != b"\x1f\x8b"
        file.seek(0)
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> None:
        raw = self.file.read(READ)
        if not raw:
            self.done = True
        elif self.plain:
            self.held += raw
        else:
            while raw:
                # no piece inflates to more than READ at once
                self.held += self.inflate.decompress(raw, READ)
                raw = self.inflate.unconsumed_tail
                if self.inflate.eof:
                    raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
                if len(self.held) >= READ and raw:
                    self.file.seek(-len(raw), 1)
                    return

    def until(self, mark: bytes, most: int = HEADERS) -> bytes | None:
        """Bytes up to and with the next ``mark``; None if nothing is left."""
        at = self.held.find(mark)
        while at < 0:
            if self.done or len(self.held) > most:
                if self.held.strip(b"\r\n"):
                    raise ValueError("a record without an end of its headers")
                return None
            self._more()
            at = self.held.find(mark)
        return self._take(at + len(mark))

    def some(self, most: int) -> bytes:
        """Between one and ``most`` bytes; none at the end."""
        while not self.held and not self.done:
            self._more()
        return self._take(min(most, len(self.held)))

    def _take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


@dataclass
class Record:
    """Headers of a record, by lower-case name, and how much of its block is left to read."""

    headers: dict[str, str]
    left: int
    digest: object = field(default_factory=hashlib.sha1)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def chunks_of(file, size: int = CHUNK) -> Iterator[tuple[dict[str, str], int, bytes, int, str, bool]]:
    """(headers, chunk number, bytes, bytes so far, base32 SHA-1 so far, last) of each chunk of each record's payload.

    An HTTP header block in front of the payload is not part of it. A record without payload has one empty chunk. At
    most a chunk and a piece of the file are held, whatever the size of a record.
    """
    source = Bytes(file)
    while (raw := source.until(b"\r\n\r\n")) is not None:
        raw = raw.lstrip(b"\r\n")
        if not raw:
            continue
        if not raw.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        record = Record(_headers(raw), 0)
        record.left = int(record.headers.get("content-length", 0))
        if "msgtype=response" in record.headers.get("content-type", ""):
            record.left -= len(source.until(b"\r\n\r\n") or b"")
        number = total = 0
        held = bytearray()
        while True:
            while record.left and len(held) < size:
                part = source.some(min(size - len(held), record.left))
                if not part:
                    raise ValueError("a record that ends too early")
                held += part
                record.left -= len(part)
            record.digest.update(held)
            total += len(held)
            sha = base64.b32encode(record.digest.copy().digest()).decode()
            yield record.headers, number, bytes(held), total, sha, not record.left
            number, held = number + 1, bytearray()
            if not record.left:
                break


def read_chunks(files: DataFrame, size: int = CHUNK) -> DataFrame:
    """A row per chunk of every record in the files of column ``path``.

    Columns: path, record (number in the file), record_id, record_type, refers_to, target_uri, declared (the digest in
    the headers), chunk, content, bytes_so_far, digest_so_far, last. The last chunk's running values are the payload's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CHUNK_FIELDS]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file = open_input(path)
                rows, held, record = [], 0, -1
                for headers, number, content, total, sha, last in chunks_of(file, size):
                    record += number == 0
                    get = headers.get
                    own = [get("warc-record-id"), get("warc-type"), get("warc-refers-to"), get("warc-target-uri"), get("warc-payload-digest")]
                    rows.append((path, record, *own, number, content, total, sha, last))
                    held += len(content) + 512
                    if held >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CHUNK_TYPES, strict=True)], names)
                        rows, held = [], 0
                file.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CHUNK_TYPES, strict=True)], names)

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(run, ", ".join(_CHUNK_FIELDS))


_CHUNK_FIELDS = [
    "path string",
    "record long",
    "record_id string",
    "record_type string",
    "refers_to string",
    "target_uri string",
    "declared string",
    "chunk long",
    "content binary",
    "bytes_so_far long",
    "digest_so_far string",
    "last boolean",
]
_CHUNK_TYPES = [
    *[pa.string(), pa.int64()],
    *[pa.string()] * 5,
    *[pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()],
]


def records(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record in a table of chunks.

    A revisit has no payload of its own: its size is that of the response it refers to, found by id and digest. A
    response whose content does not have the digest in its headers gets a null digest.
    """
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    page = lambda c: F.when(number(F.col(c)) != "", number(F.col(c)).cast("bigint"))
    declared = F.regexp_extract("declared", r"^sha1:([A-Z2-7]{32})$", 1)
    ends = chunks.filter("last").select(
        page("record_id").alias("page_id"), "bytes_so_far", "digest_so_far", declared.alias("declared"), "record_type", page("refers_to").alias("refers_to")
    )
    ends = materialize(ends, "records")
    whole = ends.filter("record_type = 'response'")
    sizes = whole.groupBy(F.col("page_id").alias("refers_to"), F.col("digest_so_far").alias("declared")).agg(F.max("bytes_so_far").alias("payload_bytes"))
    first = whole.select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.when(F.col("declared") == F.col("digest_so_far"), F.col("declared")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    again = ends.filter("record_type = 'revisit'").drop("bytes_so_far").join(sizes, ["refers_to", "declared"], "left")
    return first.unionByName(again.select("page_id", "payload_bytes", F.col("declared").alias("payload_digest"), "record_type", "refers_to"))


def round_trip(pages: DataFrame, least: int = LEAST, size: int = CHUNK) -> DataFrame:
    """Write a record per (page_id, url, html) and read the archives back.

    A null html is an empty payload, a null url leaves its header out, a null id is smaller than any. Rows that repeat
    an id and a payload are a record each, alike. Other columns are ignored; an empty table has no files and no rows.
    """
    rows = narrowed(pages, page_id="bigint", url="string", html="string")
    files = write_warc(with_types(rows, least), work_path(pages.sparkSession, "warc"))
    return records(read_chunks(files, size))


ORACLE = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h, max(page_id) over (partition by coalesce(html, '')) as largest
  from pages),
b as (
  select *, list_transform(range(0, 160), lambda i: (ascii(h[(i // 4 + 1)::int]) - case when h[(i // 4 + 1)::int] >= 'a' then 87 else 48 end) // (2 ** (3 - i % 4))::int % 2) as bits
  from p)
select page_id, n::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (16 * bits[5 * k + 1] + 8 * bits[5 * k + 2] + 4 * bits[5 * k + 3] + 2 * bits[5 * k + 4] + bits[5 * k + 5] + 1)::int, 1)), '') as payload_digest,
       case when page_id is not distinct from largest then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from largest then largest end as refers_to
from b
"""
