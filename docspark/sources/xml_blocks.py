"""One large XML file read by many tasks, with the rows that one task would give.

How it runs:

1. files are cut into blocks, each moved on to the next ``<``. There a block can only begin in one of four states: in
   text, or inside a comment, a CDATA section or a processing instruction. A task scans its block from each of these; the scans
   soon meet, so that a block is read about once. It returns one row: for each state, the state at its end, how many
   elements it closes that it did not open, and the start tags that it leaves open, with their namespaces;
2. the rows of a file, one per block, are chained, which tells every block's true state, open elements and line;
3. each block is checked alone: what follows the first malformed place of a file is dropped, as a parser would;
4. parsing resumes in every block behind the file's prolog and the open elements. A record belongs to the block that it
   starts in, and is read to its end.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from xml.parsers import expat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.runtime import materialize
from docspark.sources.io import open_input
from docspark.sources.zipped import BATCH_BYTES, TASK_BYTES

TEXT, COMMENT, CDATA, PI, BROKEN = range(5)
_OPENERS = {TEXT: b"", COMMENT: b"<!--", CDATA: b"<![CDATA[", PI: b"<?x "}
_CLOSERS = {COMMENT: b"-->", CDATA: b"]]>", PI: b"?>"}
_MARK = re.compile(rb"<(?:(!--)|(!\[CDATA\[)|(\?)|/([^\s<>/]+)\s*>|([^\s<>/!?]+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>)")
_ATTRIBUTE = re.compile(rb"\s+([^\s=]+)\s*=\s*(\"[^\"]*\"|'[^']*')")
_BREAK = re.compile(rb"\r\n?|\n")
_READ = 1 << 16
#: Most bytes of a block, whatever ``spark.sql.files.maxPartitionBytes`` says: a task holds one.
BLOCK_BYTES = 32 << 20


def _tag(mark: re.Match) -> bytes:
    """A start tag with its namespace declarations only."""
    kept = [m[0] for m in _ATTRIBUTE.finditer(mark[6]) if m[1] == b"xmlns" or m[1].startswith(b"xmlns:")]
    return b"<" + mark[5] + b"".join(kept) + b">"


class _Scan:
    """Start and end tags from a place on, until a place that an earlier scan has been at."""

    def __init__(self, data: bytes, at: int, state: int, known: list[_Scan]):
        self.data, self.at, self.steps = data, array("q"), array("b")
        self.end, self.goes_on = self._run(at, state, known)

    def _run(self, at: int, state: int, known: list[_Scan]):
        data = self.data
        while True:
            if state != TEXT:
                closer = _CLOSERS[state]
                at = data.find(closer, at)
                if at < 0:
                    return state, None
                at, state = at + len(closer), TEXT
            at = data.find(b"<", at)
            if at < 0:
                return TEXT, None
            mark = _MARK.match(data, at)
            if mark is None:
                return BROKEN, None
            if mark[1] or mark[2] or mark[3]:
                state = COMMENT if mark[1] else CDATA if mark[2] else PI
                at = mark.end()
                continue
            step = -1 if mark[4] else 0 if mark[6].endswith(b"/") else 1
            if step:
                for scan in known:
                    spot = bisect_left(scan.at, at)
                    if spot < len(scan.at) and scan.at[spot] == at:
                        return scan.end, (scan, spot)
                self.at.append(at)
                self.steps.append(step)
            at = mark.end()

    def _all(self) -> tuple[np.ndarray, np.ndarray]:
        at, steps = [np.array(self.at, np.int64)], [np.array(self.steps, np.int64)]
        rest = self.goes_on
        while rest:
            scan, spot = rest
            at.append(np.array(scan.at[spot:], np.int64))
            steps.append(np.array(scan.steps[spot:], np.int64))
            rest = scan.goes_on
        return np.concatenate(at), np.concatenate(steps)

    def effect(self) -> tuple[int, list[bytes]]:
        """(elements closed that were open before, start tags of the elements left open)."""
        at, steps = self._all()
        if not len(at):
            return 0, []
        depth = np.cumsum(steps)
        later = np.minimum.accumulate(depth[::-1])[::-1]
        left = at[(steps > 0) & (later >= depth)]
        return max(0, -int(depth.min())), [_tag(_MARK.match(self.data, int(x))) for x in left]


def _extent(data: bytes) -> tuple[int, int, int]:
    """(line breaks, bytes after the last one, characters of UTF-8 after it)."""
    breaks, last = 0, 0
    if b"\r" in data:
        for m in _BREAK.finditer(data):
            breaks, last = breaks + 1, m.end()
    else:
        breaks, last = data.count(b"\n"), data.rfind(b"\n") + 1
    tail = np.frombuffer(data, np.uint8, offset=last)
    return breaks, len(tail), int(((tail & 0xC0) != 0x80).sum())


class _Head:
    """Root, first child and encoding of a file, from its first bytes."""

    def __init__(self, data: bytes):
        self.root, self.depth, self.child, self.encoding = None, 0, None, "UTF-8"
        p = self.parser = expat.ParserCreate(namespace_separator=" ")
        p.StartElementHandler, p.EndElementHandler, p.XmlDeclHandler = self._start, self._end, self._declaration
        try:
            for lo in range(0, len(data), _READ):
                p.Parse(data[lo : lo + _READ], False)
                if self.child is not None:
                    break
        except expat.ExpatError:
            pass

    def _declaration(self, version, encoding, standalone) -> None:
        self.encoding = (encoding or "UTF-8").upper()

    def _start(self, name: str, attrs: dict) -> None:
        self.depth += 1
        if self.depth == 1:
            self.root = self.parser.CurrentByteIndex
        elif self.depth == 2 and self.child is None:
            uri, _, local = name.rpartition(" ")
            self.child = local, uri

    def _end(self, name: str) -> None:
        self.depth -= 1


_SCAN_DDL = (
    "src_id string, length bigint, start bigint, stop bigint, breaks bigint, tail bigint, tail_chars bigint, ends array<int>, "
    "closes array<bigint>, opens array<array<binary>>, root bigint, element string, ns string, utf8 boolean"
)


def _block(f, start: int, size: int, length: int) -> tuple[int, bytes]:
    """(place, bytes) of the block that begins at the first ``<`` from ``start`` on, and ends before that of the next."""
    f.seek(start)
    data = f.read(min(size, length - start))
    cut = data.find(b"<")
    if cut < 0:
        return start, b""
    if start == 0:
        cut = 0
    parts = [data[cut:]]
    while more := f.read(_READ):
        at = more.find(b"<")
        parts.append(more if at < 0 else more[:at])
        if at >= 0:
            break
    return start + cut, b"".join(parts)


def _scan_blocks(size: int, named: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for src, length, start in zip(batch["src_id"], batch["length"], batch["start"], strict=True):
                with open_input(src) as f:
                    place, data = _block(f, start, size, length)
                head = [None, None, None, None]
                at = 0
                if start == 0:
                    of = _Head(data)
                    # text of two or four bytes a character cannot be cut
                    if of.root is not None and (named or of.child) and b"\0" not in data[:4] and data[:2] not in (b"\xff\xfe", b"\xfe\xff"):
                        head = [of.root, *(of.child or (None, None)), of.encoding in ("UTF-8", "US-ASCII")]
                    at = of.root or 0
                scans: list[_Scan] = []
                for state in (TEXT, COMMENT, CDATA, PI):
                    scans.append(_Scan(data, at, state, scans))
                effects = [s.effect() for s in scans]
                row = [src, length, place, place + len(data), *_extent(data), [s.end for s in scans], [e[0] for e in effects], [e[1] for e in effects], *head]
                yield pd.DataFrame([row], columns=[c.split()[0] for c in _SCAN_DDL.split(", ")])

    return run


_PLACE_DDL = (
    "src_id string, start bigint, stop bigint, length bigint, state int, open array<binary>, line bigint, col bigint, "
    "root bigint, element string, ns string"
)


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of one file begins; a file that cannot be cut is one row without a state."""
    blocks = blocks.sort_values("start")
    columns = [c.split()[0] for c in _PLACE_DDL.split(", ")]
    first = blocks.iloc[0]
    src, length = first["src_id"], int(first["length"])
    if pd.isna(first["root"]):
        return pd.DataFrame([(src, 0, length, length, None, [], 1, 0, 0, None, None)], columns=columns)
    utf8, state, stack, line, col, out = bool(first["utf8"]), TEXT, [], 1, 0, []
    for b in blocks.itertuples(index=False):
        if b.start == b.stop:
            continue
        out.append((src, b.start, b.stop, length, state, list(stack), line, col, int(first["root"]), first["element"], first["ns"]))
        closes = int(b.closes[state])
        if b.ends[state] == BROKEN or closes > len(stack):
            break  # the parser stops in this block
        stack = stack[: len(stack) - closes] + list(b.opens[state])
        state = b.ends[state]
        tail = int(b.tail_chars if utf8 else b.tail)
        line, col = line + int(b.breaks), tail if b.breaks else col + tail
    return pd.DataFrame(out, columns=columns).astype({"state": "Int32"})


def _opening(f, row) -> bytes:
    """What stands for all that lies before a block."""
    if row.start == 0:
        return b""
    f.seek(0)
    prolog = f.read(int(row.root))
    # behind the root's end there is still a root
    return prolog + (b"".join(row.open) or b"<x/>") + _OPENERS[row.state]


class _Places:
    """Lines and columns of the file from those of a parser that began with an opening."""

    def __init__(self, opening: bytes, row):
        breaks, _, chars = _extent(opening)
        self.breaks, self.chars, self.line, self.col = breaks, chars, row.line, row.col

    def of(self, line: int, col: int) -> tuple[int, int]:
        line -= self.breaks
        return (self.line, self.col + col - self.chars) if line == 1 else (self.line + line - 1, col)


def _until(f, start: int, stop: int) -> Iterator[bytes]:
    f.seek(start)
    while start < stop and (data := f.read(min(_READ, stop - start))):
        start += len(data)
        yield data


def _is_fine(f, row) -> bool:
    """Whether a block parses behind its opening."""
    parser = expat.ParserCreate(namespace_separator=" ")
    try:
        parser.Parse(_opening(f, row), False)
        for data in _until(f, row.start, row.stop):
            parser.Parse(data, False)
        if row.stop == row.length:
            parser.Parse(b"", True)
    except expat.ExpatError:
        return False
    return True


def _resume(f, row, make) -> Iterator[tuple]:
    """(line, col, n, raw_uri, text, reason) of the records that start in a block; ``n`` counts them from 1."""
    opening = _opening(f, row)
    places, records, n = _Places(opening, row), make(), 0
    shift = row.start - len(opening)
    inside = lambda: records.record_depth and len(opening) <= records.start < row.stop - shift

    def some(data: bytes, last: bool = False) -> Iterator[tuple]:
        nonlocal n
        for line, col, at, raw_uri, text in records.cut(data, last, len(opening)):
            if at < row.stop - shift:
                n += 1
                yield *places.of(line, col), n, raw_uri, text, None

    try:
        for _ in records.cut(opening, False, len(opening)):
            pass
        for data in _until(f, row.start, row.stop):
            yield from some(data)
        if row.stop == row.length:
            yield from some(b"", True)
    except expat.ExpatError as e:
        line, col = places.of(e.lineno, e.offset)
        yield line, col, 0, None, None, f"malformed XML: {expat.ErrorString(e.code)}: line {line}, column {col}"
        return
    at = row.stop
    try:
        while inside():
            f.seek(at)
            data = f.read(_READ)
            at += len(data)
            yield from some(data, not data)
    except expat.ExpatError:
        return  # reported by the block that it lies in


def spread(rows: DataFrame, n: int, size: int) -> DataFrame:
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(n, max(4 * parallel, -(-n * size // TASK_BYTES)))))


def block_size(spark) -> int:
    """``spark.sql.files.maxPartitionBytes``, with a bound."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1], 1)
    return min(BLOCK_BYTES, max(1, int(text.rstrip("kmgt")) * unit))


def read_blocks(files: DataFrame, element: str | None, ns: str | None, make, whole, ddl: str, numbered: bool, size: int | None = None) -> DataFrame:
    """Records of files (src_id, bytes_n): (src_id, sub_id) and the columns of ``ddl``.

    ``make(element, ns)`` makes the parser of records, ``whole(path)`` yields all records of a file that cannot be cut: a
    small, compressed or UTF-16 file, one whose root lies beyond the first block, or that is malformed before.
    ``numbered``: whether ``n`` must count through the file. ``size``: bytes of a block.
    """
    size = size or block_size(files.sparkSession)
    starts = F.when(F.lower("src_id").rlike(r"\.gz(ip)?$"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("bytes_n") - 1, F.lit(size)))
    # one small row per block, so that files are listed once
    listed = materialize(files.select("src_id", F.col("bytes_n").alias("length"), F.explode(starts).alias("start")), "xml-files")
    listed = listed.withColumn("large", (F.col("length") > size) & ~F.lower("src_id").rlike(r"\.gz(ip)?$"))
    small = listed.filter("not large").select("src_id", "length")
    n = listed.count()
    scanned = spread(listed.filter("large"), n, size).mapInPandas(_scan_blocks(size, element is not None), _SCAN_DDL)
    placed = scanned.groupBy("src_id").applyInPandas(_chain, _PLACE_DDL)
    null = lambda kind: F.lit(None).cast(kind)
    alone = small.select(
        "src_id", F.lit(0).cast("bigint").alias("start"), F.col("length").alias("stop"), "length", null("int").alias("state"),
        null("array<binary>").alias("open"), F.lit(1).cast("bigint").alias("line"), F.lit(0).cast("bigint").alias("col"),
        F.lit(0).cast("bigint").alias("root"), null("string").alias("element"), null("string").alias("ns"),
    )
    placed = materialize(placed.unionByName(alone), "xml-blocks")

    def named(row):
        return (element, ns) if element is not None else (row.element, row.ns)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fine, count = [], []
            for row in batch.itertuples(index=False):
                ok, k = True, 0
                if not pd.isna(row.state):
                    with open_input(row.src_id) as f:
                        if numbered:
                            for rec in _resume(f, row, lambda row=row: make(*named(row))):
                                ok, k = ok and rec[5] is None, max(k, rec[2])
                        else:
                            ok = _is_fine(f, row)
                fine.append(ok)
                count.append(k)
            yield batch.assign(fine=fine, count=count)

    checked = materialize(spread(placed, n, size).mapInPandas(check, f"{_PLACE_DDL}, fine boolean, count bigint"), "xml-checked")
    before = Window.partitionBy("src_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    kept = checked.withColumn("good", F.coalesce(F.min("fine").over(before), F.lit(True)))
    kept = kept.withColumn("first_n", F.coalesce(F.sum("count").over(before), F.lit(0))).filter("good")
    names = ["src_id", "sub_id", *[c.split()[0] for c in ddl.split(", ")]]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if pd.isna(row.state):
                    found = whole(row.src_id)
                else:
                    f = open_input(row.src_id)
                    found = _resume(f, row, lambda row=row: make(*named(row)))
                for line, col, k, *rest in found:
                    out.append((row.src_id, "", line, col, k + row.first_n if k else 0, *rest))
                    held += 64 + len(rest[1] or "")
                    if held >= BATCH_BYTES or len(out) >= 20_000:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    return spread(kept, n, size).mapInPandas(read, "src_id string, sub_id string, " + ddl)
