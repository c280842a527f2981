"""Records inside aggregate XML files."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from xml.parsers import expat
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.uri import file_path_of, uri_build
from docspark.schema import to_docs
from docspark.sources.files import list_files
from docspark.sources.xml_blocks import read_blocks
from docspark.sources.zipped import entry_rows, file_rows, open_file, stream_records

NO_ID = "record without a URI id"
_RECORD_DDL = "line bigint, col int, n bigint, raw_uri string, text string, reason string"
_TAG = re.compile(rb"<(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
_FEED = 1 << 16


class _Records:
    """Cuts records out of a byte stream verbatim, by the parser's byte positions."""

    def __init__(self, element: str | None, ns: str | None, uri_id: str | None):
        self.element, self.ns = element, ns
        self.attr = uri_id[1:] if uri_id and uri_id.startswith("@") else None
        self.id_element = uri_id if uri_id and not self.attr else None
        self.depth, self.n = 0, 0
        self.record_depth = 0
        self.scopes: list[dict[str, str]] = []
        self.pending: dict[str, str] = {}
        self.buffer, self.base = bytearray(), 0
        self.done: list[tuple] = []
        self.encoding = "UTF-8"
        p = self.parser = expat.ParserCreate(namespace_separator=" ")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler = self._start, self._end
        p.CharacterDataHandler = self._chars
        p.StartNamespaceDeclHandler = self._namespace
        p.XmlDeclHandler = self._declaration

    def _declaration(self, version, encoding, standalone) -> None:
        self.encoding = encoding or "UTF-8"

    def _namespace(self, prefix, uri) -> None:
        self.pending[prefix or ""] = uri or ""

    def _start(self, name: str, attrs: dict) -> None:
        uri, _, local = name.rpartition(" ")
        self.depth += 1
        own, self.pending = self.pending, {}
        self.scopes.append(own)
        if not self.record_depth:
            if self.element is None and self.depth == 2:
                self.element, self.ns = local, uri
            if self.depth > 1 and local == self.element and (self.ns or "") == uri:
                self.record_depth, self.raw_uri, self.id_text = self.depth, None, None
                self.start = self.parser.CurrentByteIndex
                self.at = self.parser.CurrentLineNumber, self.parser.CurrentColumnNumber
                self.own = own
        if self.record_depth:
            if self.attr and self.raw_uri is None:
                self.raw_uri = next((_escape(v) for k, v in attrs.items() if k.rpartition(" ")[2] == self.attr), None)
            if self.id_element == local and self.raw_uri is None and self.id_text is None:
                self.id_text, self.id_depth = [], self.depth

    def _chars(self, data: str) -> None:
        if self.record_depth and self.id_text is not None:
            self.id_text.append(data)

    def _end(self, name: str) -> None:
        if self.record_depth and self.id_text is not None and self.depth == self.id_depth:
            self.raw_uri, self.id_text = _escape("".join(self.id_text)), None
        if self.record_depth == self.depth:
            self.done.append((self.start, self.parser.CurrentByteIndex, self.at, self._outer(), self.raw_uri))
            self.record_depth = 0
        self.scopes.pop()
        self.depth -= 1

    def _outer(self) -> dict[str, str]:
        """Namespaces in scope at the record that it does not declare itself."""
        known: dict[str, str] = {}
        for scope in self.scopes[: self.record_depth - 1]:
            known.update(scope)
        return {p: u for p, u in known.items() if p not in self.own and (u or p)}

    def _cut(self, start: int, end: int, outer: dict[str, str]) -> str:
        at = end - self.base
        # an empty-element tag has no end tag, the record is that tag
        last = _TAG.match(self.buffer, at if self.buffer[at : at + 2] == b"</" else start - self.base)
        raw = bytes(self.buffer[start - self.base : last.end()]).decode(self.encoding)
        if not outer:
            return raw
        head = re.match(r"<[^\s/>]+", raw)[0]
        declared = "".join(
            f' xmlns{":" + p if p else ""}="{_escape(u)}"' for p, u in sorted(outer.items())
        )
        return head + declared + raw[len(head) :]

    def cut(self, data: bytes, last: bool, skip: int = 0) -> Iterator[tuple]:
        """(line, col, start, raw_uri, text) of the records that end in ``data``, but for those that start before byte ``skip``."""
        self.buffer += data
        error = None
        try:
            self.parser.Parse(data, last)
        except expat.ExpatError as e:
            error = e
        for start, end, (line, col), outer, raw_uri in self.done:
            if start >= skip:
                yield line, col, start, raw_uri, self._cut(start, end, outer)
        self.done = []
        if error is not None:
            raise error
        # only an open record still needs its bytes
        keep = self.start if self.record_depth and self.start >= skip else self.parser.CurrentByteIndex
        if 0 <= self.base < keep:
            del self.buffer[: keep - self.base]
            self.base = keep

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple]:
        for line, col, _, raw_uri, text in self.cut(data, last):
            self.n += 1
            yield line, col, self.n, raw_uri, text, None


def _escape(text: str) -> str:
    return escape(text, {'"': "&quot;", "'": "&apos;"})


def _parser(element: str | None, ns: str | None, uri_id: str | None):
    def parse(stream, src_id: str, entry: str) -> Iterator[tuple]:
        records = _Records(element, ns, uri_id)
        try:
            while data := stream.read(_FEED):
                yield from records.feed(data)
            yield from records.feed(b"", True)
        except expat.ExpatError as e:
            # records read so far stand, the rest of the file is reported
            yield e.lineno, e.offset, 0, None, None, f"malformed XML: {e}"

    return parse


def _whole(parse, path: str) -> Iterator[tuple]:
    """All records of a file, by one task."""
    try:
        with open_file(path) as stream:
            yield from parse(stream, path, "")
    except (zlib.error, EOFError, UnicodeDecodeError) as e:
        yield 0, 0, 0, None, None, f"unreadable: {e}"


def _to_documents(rows: DataFrame, uri_id: str | None, uri_options: dict) -> DataFrame:
    if uri_id is None:
        source = F.concat_ws("/", file_path_of(F.col("src_id")), F.nullif(F.col("sub_id"), F.lit("")))
        raw = F.concat(source, F.lit("-0-"), F.col("n").cast("string"))
    else:
        raw = F.col("raw_uri")
    missing = F.when(F.coalesce(raw, F.lit("")) == "", F.lit(NO_ID))
    uri, uri_reason = uri_build(raw, **uri_options)
    reason = F.coalesce("reason", missing, uri_reason)
    df = rows.withColumn("skip_reason", reason).withColumn("_uri", uri)
    ok = F.col("skip_reason").isNull()
    return to_docs(df, uri=F.when(ok, F.col("_uri")), text=F.when(ok, F.col("text")), content_type=F.lit("XML"))


def read_xml_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    element: str | None = None,
    ns: str | None = None,
    uri_id: str | None = None,
    pattern: str | None = None,
    zipped: bool = False,
    split: bool = False,
    block_bytes: int | None = None,
    **uri_options,
) -> DataFrame:
    """Each ``element`` of namespace ``ns`` (default: the first child of the root) as one document, verbatim,
    with the namespaces in scope declared on it. ``uri_id`` is an element name or ``@attribute``; without it URIs
    are generated. A record without an id is rejected.

    Default: a file (plain or ``.gz``) or zip entry is streamed by one task. ``split=True`` gives the same rows and
    rejects, but has a large file read by many tasks, in blocks of ``block_bytes`` (``spark.sql.files.maxPartitionBytes``). Compressed and
    UTF-16 files, and zip entries, cannot be cut.
    """
    parse = _parser(element, ns, uri_id)
    if split and not zipped:
        make = lambda name, uri: _Records(name, uri, uri_id)
        files = list_files(spark, paths, pattern).where(F.col("bytes_n") > 0).select("src_id", "bytes_n")
        rows = read_blocks(files, element, ns, make, lambda path: _whole(parse, path), _RECORD_DDL, uri_id is None, block_bytes)
        return _to_documents(rows, uri_id, uri_options)
    listing = entry_rows(spark, paths, pattern) if zipped else file_rows(spark, paths, pattern)
    rows = stream_records(listing, parse, _RECORD_DDL, lambda why: (0, 0, 0, None, None, why))
    return _to_documents(rows, uri_id, uri_options)
