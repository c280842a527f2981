"""Delimited text: header plus rows to documents."""

from __future__ import annotations

import csv
import io
import re
from collections import deque
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docspark.functions.build import pairs_to_json, pairs_to_xml, row_to_json, row_to_xml, valid_name
from docspark.functions.uri import uri_build, uri_generate
from docspark.runtime import is_small, materialize, maybe_broadcast, ship
from docspark.schema import to_docs
from docspark.sources.files import MAX_BYTES, text_lines
from docspark.sources.numbering import first_in_split, mark_quotes, number_in_split
from docspark.sources.zipped import entry_rows, file_rows, stream_records

WIDTH_REASON = "the row is wider or narrower than its header"
OPEN_REASON = "quoted field is never closed"
QUOTE_REASON = "text beside a quoted field"
_RECORD_DDL = "line bigint, names array<string>, vals array<string>, raw string, reason string"


class _Lines:
    """Lines of a stream, keeping those of the record being read; lines can be put back."""

    def __init__(self, text):
        self._text, self._back, self.seen, self.number = text, deque(), [], 0

    def __iter__(self):
        return self

    def __next__(self) -> str:
        line = self._back.popleft() if self._back else next(self._text)
        self.seen.append(line)
        self.number += 1
        return line

    def put_back(self, lines: list[str]) -> None:
        self._back.extendleft(reversed(lines))
        self.number -= len(lines)


def _resume_at(lines: list[str], delimiter: str, width: int | None) -> int:
    """Of the lines of a record that cannot be closed, the first after which records are read again.

    That is the second or a later one that, like the one after it, is a whole record as wide as the header; the number of
    lines if there is none. A quote that was opened by mistake so costs one row.
    """

    def whole(k: int) -> bool:
        fields = _split_record(lines[k], delimiter) if k < len(lines) else None
        return k >= len(lines) or fields is not None and len(fields) == width

    last = len(lines) - 1
    # the last line may be the first of a record that goes on
    return next((k for k in range(1, len(lines)) if whole(k) and (k + 1 >= last or whole(k + 1))), len(lines))


def _split_record(raw: str, delimiter: str) -> list[str] | None:
    """Fields of one record: spaces around a field go, those inside quotes stay. None if malformed."""
    d = re.escape(delimiter)
    blank = " " if delimiter == "\t" else " \\t"
    token = re.compile(rf'[{blank}]*(?:"((?:[^"]|"")*)"[{blank}]*|([^"{d}\r\n][^{d}\r\n]*|))(?:({d})|\r?\n?$)')
    fields, at = [], 0
    while True:
        m = token.match(raw, at)
        if m is None:
            return None
        fields.append(m[1].replace('""', '"') if m[1] is not None else m[2].strip())
        if m[3] is None:
            return fields
        at = m.end()


def _records(stream, delimiter: str, encoding: str) -> Iterator[tuple[int, list[str] | None]]:
    """(line number, fields) of each record; fields are None where the quoting is malformed."""
    lines = _Lines(io.TextIOWrapper(stream, encoding=encoding, newline=""))
    csv.field_size_limit(2**31 - 1)
    # a quote opens a field only at its start, so skip leading blanks unless they delimit
    reader = csv.reader(lines, delimiter=delimiter, quotechar='"', skipinitialspace=True, strict=True)
    width = None
    while True:
        lines.seen = []
        try:
            fields = next(reader)
        except StopIteration:
            return
        except csv.Error:
            fields = _split_record("".join(lines.seen), delimiter)
        else:
            if any(f and f[-1].isspace() for f in fields):
                raw = "".join(lines.seen)
                fields = _split_record(raw, delimiter) if '"' in raw else [f.strip() for f in fields]
        if fields is None and len(lines.seen) > 1:
            lines.put_back(lines.seen[_resume_at(lines.seen, delimiter, width) :])
        if fields is None or (fields and fields != [""]):
            width = len(fields) if width is None and fields else width
            yield lines.number, fields


def _header_of(fields: list[str]) -> list[str]:
    fields = [f.strip() for f in fields]
    return [fields[0].removeprefix("\ufeff"), *fields[1:]]


def _record_parser(delimiter: str, encoding: str, uri_id: str | None, generate_uri: bool, xml: bool):
    """Parser of one file or archive entry; a row has the names of its own header, its values and its raw URI."""

    def parse(stream, src_id: str, entry: str) -> Iterator[tuple]:
        header = None
        for line, fields in _records(stream, delimiter, encoding):
            if header is None:
                if fields is None:
                    yield line, [], [], None, QUOTE_REASON
                    return
                header = _header_of(fields)
                # of columns with one name the last counts, at the place of the first; those without a name are left out
                at = {h: i for i, h in enumerate(header) if h}
                names = [valid_name(h) for h in at] if xml else list(at)
                lost = None
                if not generate_uri and uri_id is not None and uri_id not in header:
                    lost = f"uri_id {uri_id} is not found"
                uri = None if generate_uri or lost else header.index(uri_id) if uri_id is not None else 0
                continue
            if fields is None:
                yield line, [], [], None, QUOTE_REASON
            elif len(fields) != len(header):
                yield line, [], [], None, WIDTH_REASON
            elif lost:
                yield line, [], [], None, lost
            else:
                yield line, names, [fields[i] for i in at.values()], None if uri is None else fields[uri], None

    return parse


def _document_columns(header: list[str], generate_uri: bool, uri_id, doc_type, data_type, root_name, lenient):
    """(raw URI, body, reason) of a row array ``vals`` under one header."""
    null = F.lit(None).cast("string")
    if not generate_uri and uri_id is not None and uri_id not in header:
        return null, null, F.lit(f"uri_id {uri_id} is not found")
    columns = {h: F.get(F.col("vals"), F.lit(i)) for i, h in enumerate(header) if h}
    try:
        if doc_type.upper() == "JSON":
            body, type_reason = row_to_json(columns, data_type, lenient)
        else:
            body, type_reason = row_to_xml(columns, root_name), null
    except ValueError as e:
        return null, null, F.lit(str(e))
    i = header.index(uri_id) if uri_id is not None else 0
    return null if generate_uri else F.get(F.col("vals"), F.lit(i)), body, type_reason


def _documents(rows: DataFrame, columns: tuple, doc_type: str, uri_options: dict, generate_uri: bool) -> DataFrame:
    """Documents of (src_id, sub_id, block, line, reason) and the columns (raw URI, body, reason of the body)."""
    raw, body, type_reason = columns
    df = rows.select(
        "src_id", "sub_id", "block", "line", F.coalesce("reason", type_reason).alias("reason"),
        raw.alias("_raw"), body.alias("_body"),
    )
    if generate_uri:
        # only good records take a number
        source = F.concat_ws("/", "src_id", F.nullif(F.col("sub_id"), F.lit("")))
        df = df.withColumn("_good", F.col("reason").isNull()).withColumn("_file", source)
        df = number_in_split(df, ("_file", "block"), counted="_good")
        df = df.withColumn("_raw", uri_generate(F.col("_file"), F.col("block"), F.col("n")))
    uri, uri_reason = uri_build(F.col("_raw"), **uri_options)
    df = df.withColumn("skip_reason", F.coalesce("reason", uri_reason)).withColumn("_uri", uri)
    ok = F.col("skip_reason").isNull()
    return to_docs(
        df, uri=F.when(ok, F.col("_uri")), text=F.when(ok, F.col("_body")), content_type=F.lit(doc_type.upper())
    )


def read_csv_docs(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    uri_id: str | None = None,
    generate_uri: bool = False,
    doc_type: str = "XML",
    data_type=None,
    root_name: str = "root",
    encoding: str = "UTF-8",
    pattern: str | None = None,
    split: bool | str = False,
    zipped: bool = False,
    lenient: bool = False,
    **uri_options,
) -> DataFrame:
    """Rows of delimited files as XML or JSON documents; the URI is the ``uri_id`` column, else the first.

    Default: each file (plain or ``.gz``) or zip entry is streamed by one task; quoted line breaks, any
    charset and a header per file are allowed. A quote that is opened and never closed costs its row: reading goes on at the
    next lines that are records as wide as the header. ``split=True`` cuts files into blocks parsed by many tasks
    inside the JVM; a record must then be one line of UTF-8 and all files share one header. Use it for
    files larger than a task should read. ``split="quoted"`` also allows line breaks inside quotes, if quotes
    only ever enclose fields; it needs a URI column. There, behind a quote that is never closed, records of one line are read.
    """
    if len(delimiter) != 1:
        raise ValueError(f"a delimiter is one character, not {delimiter!r}")
    kw = dict(
        uri_id=uri_id, doc_type=doc_type, data_type=data_type, root_name=root_name, lenient=lenient,
        uri_options=uri_options, generate_uri=generate_uri,
    )
    if split == "quoted":
        if generate_uri:
            raise ValueError("generated URIs need records in file order: use a URI column with split='quoted'")
        return _read_split_quoted(spark, paths, delimiter, pattern, encoding, kw)
    if split:
        return _read_split(spark, paths, delimiter, pattern, encoding, kw)
    listing = entry_rows(spark, paths, pattern) if zipped else file_rows(spark, paths, pattern)
    xml = doc_type.upper() != "JSON"
    parse = _record_parser(delimiter, encoding, uri_id, generate_uri, xml)
    rows = stream_records(listing, parse, _RECORD_DDL, lambda why: (0, [], [], None, why)).withColumn("block", F.lit(0))
    # names travel with the rows, so that neither the driver nor the plan knows how many headers there are
    if xml:
        body, type_reason = pairs_to_xml("names", "vals", root_name), F.lit(None).cast("string")
    else:
        body, type_reason = pairs_to_json("names", "vals", data_type, lenient)
    return _documents(rows, (F.col("raw"), body, type_reason), doc_type, uri_options, generate_uri)


def _read_split(spark: SparkSession, paths, delimiter: str, pattern: str | None, encoding: str, kw: dict) -> DataFrame:
    found = text_lines(spark, paths, pattern, encoding)
    lines = number_in_split(found, name="line")
    lines = lines.withColumn("line", F.col("block") + F.col("line")).where(F.trim("value") != "")
    header_line, firsts = _headers(found)
    if header_line is None:
        return to_docs(spark.createDataFrame([], "src_id string"))
    # records are numbered behind this join: it must not deal them anew where that can be helped
    rows = lines.join(F.broadcast(firsts) if is_small(firsts) else firsts, ["src_id", "line"], "left_anti")
    rows = rows.select("src_id", "block", "line", F.col("value").alias("raw"), F.lit(None).cast("string").alias("reason"))
    return _parse_records(rows, header_line, delimiter, kw)


def _headers(lines: DataFrame) -> tuple[str | None, DataFrame]:
    """(the header of all files, a row (src_id, line) per file) of the lines of blocks; an error if headers differ.

    The header is the first line with text of its file. Of a string, Spark takes the least by sorting all rows of a task,
    so that only the first line of each block is grouped.
    """
    firsts = first_in_split(lines.withColumn("_text", F.coalesce(F.trim("value") != "", F.lit(False))), "_text", name="line")
    firsts = firsts.withColumn("line", F.col("block") + F.col("line"))
    firsts = firsts.groupBy("src_id").agg(F.min("line").alias("line"), F.min_by("value", "line").alias("value"))
    header = F.ltrim(F.regexp_replace("value", "\r$", ""), F.lit("\ufeff"))
    firsts = materialize(firsts.withColumn("value", header), "csv-headers")
    found = firsts.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    if found.lo != found.hi:
        raise ValueError("all files must share one header")
    return found.lo, firsts.select("src_id", "line")


def _read_split_quoted(spark: SparkSession, paths, delimiter: str, pattern: str | None, encoding: str, kw: dict) -> DataFrame:
    """Blocks of files whose quoted fields hold line breaks.

    A line starts a record if an even number of quotes lies before it in its file. Each task counts quotes and
    record starts in its block under both assumptions about where the block begins; the quote totals of the
    blocks, one row per block, tell which holds. Only lines of records that span lines are then shuffled.
    """
    value = F.col("value")
    found = text_lines(spark, paths, pattern, encoding, lineSep="\n")
    numbered = number_in_split(found, name="id").withColumn("id", F.col("block") + F.col("id"))
    header_line, _ = _headers(found)
    if header_line is None:
        return to_docs(spark.createDataFrame([], "src_id string"))
    lines = numbered.select(
        F.regexp_replace(value, "\r$", "").alias("value"),
        "src_id",
        "block",
        "id",
        (F.length(value) - F.length(F.translate(value, '"', ""))).alias("quotes"),
    )
    marked = materialize(mark_quotes(lines), "csv-lines")
    blocks = marked.groupBy("src_id", "block").agg(
        F.sum("quotes").alias("total"), F.max("rec0").alias("max0"), F.max("rec1").alias("max1"),
        F.min(F.when(F.trim("value") != "", F.col("id"))).alias("first_id"),
    )
    earlier = Window.partitionBy("src_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("total").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("records", F.when(F.col("odd") == 1, F.col("max1")).otherwise(F.col("max0")))
    has = F.when(F.col("records") > 0, F.struct(F.col("block").alias("b"), F.col("records").alias("r")))
    blocks = blocks.select(
        "src_id", "block", "odd", "first_id", F.last(has, ignorenulls=True).over(earlier).alias("before_block"),
        F.min("first_id").over(earlier).alias("seen"),
    )
    at = marked.join(maybe_broadcast(blocks), ["src_id", "block"])
    # the header is the first line with text of its file
    is_header = F.col("seen").isNull() & (F.col("id") == F.col("first_id"))
    at = at.where(~F.coalesce(is_header, F.lit(False)))
    outside = (F.col("before") + F.col("odd")) % 2 == 0
    closed = (F.col("before") + F.col("odd") + F.col("quotes")) % 2 == 0
    record = F.when(F.col("odd") == 1, F.col("rec1")).otherwise(F.col("rec0"))
    none = F.lit(None).cast("string")
    single = at.where(outside & closed & (F.trim("value") != "")).select(
        "src_id", "block", F.col("id").alias("line"), value.alias("raw"), none.alias("reason")
    )
    parts = at.where(~(outside & closed)).select(
        "src_id", "id", "value",
        F.when(record > 0, F.col("block")).otherwise(F.col("before_block.b")).alias("_b"),
        F.when(record > 0, record).otherwise(F.col("before_block.r")).alias("_r"),
        F.col("block").alias("_part"),
    )
    key = ["src_id", "_b", "_r"]
    # a quote that is never closed may run to the end of a file: such a record is reported, not gathered
    sizes = parts.groupBy(*key).agg(F.sum(F.octet_length("value") + 1).alias("n"), F.min("id").alias("line")).where(F.col("n") > MAX_BYTES)
    endless = materialize(sizes, "csv-endless")
    gathered = parts.join(maybe_broadcast(endless), key, "left_anti").groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("_part", "id", "value"))).alias("_l")
    )
    ship(spark)
    width = len(_header_of(_split_record(header_line, delimiter)))
    apart = F.when(F.size("_l") > 1, _whole_lines(delimiter, width)(F.transform("_l", lambda x: x["value"])))
    gathered = materialize(gathered.withColumn("_apart", apart), "csv-records")
    multi = gathered.where("_apart is null").select(
        "src_id", F.col("_b").alias("block"), F.get("_l", F.lit(0))["id"].alias("line"),
        F.array_join(F.transform("_l", lambda x: x["value"]), "\n").alias("raw"),
        none.alias("reason"),
    )
    broken = gathered.where("_apart is not null")
    first = broken.select("src_id", F.col("_b").alias("block"), F.get("_l", F.lit(0))["id"].alias("line"), F.lit("").alias("raw"), F.lit(QUOTE_REASON).alias("reason"))
    alone = broken.select("src_id", F.col("_b").alias("block"), F.explode("_apart").alias("_k"), "_l")
    alone = alone.withColumn("_x", F.get("_l", F.col("_k"))).select("src_id", "block", F.col("_x.id").alias("line"), F.col("_x.value").alias("raw"), none.alias("reason"))
    lost = endless.select("src_id", F.col("_b").alias("block"), "line", F.lit("").alias("raw"), F.lit(OPEN_REASON).alias("reason"))
    # lines of a record larger than a row are taken one by one, where they lie
    behind = parts.join(maybe_broadcast(endless.withColumnRenamed("line", "_first")), key).where((F.col("id") > F.col("_first")) & (F.trim("value") != ""))
    behind = behind.select("src_id", F.col("_part").alias("block"), F.col("id").alias("line"), F.col("value").alias("raw"), none.alias("reason"))
    every = [single, multi, first, alone, lost, behind]
    return _parse_records(reduce(DataFrame.unionByName, every), header_line, delimiter, kw)


def _whole_lines(delimiter: str, width: int):
    """A column function: of the lines of a record that is malformed, the numbers of those to read alone; else null."""

    @F.pandas_udf("array<int>")
    def run(records: pd.Series) -> pd.Series:
        def one(lines) -> list[int] | None:
            if lines is None or _split_record("\n".join(lines), delimiter) is not None:
                return None
            return [k for k in range(_resume_at(list(lines), delimiter, width), len(lines)) if lines[k].strip()]

        return records.map(one)

    return run


def _parse_records(lines: DataFrame, header_line: str, delimiter: str, kw: dict) -> DataFrame:
    """Documents of whole records (src_id, block, line, raw, reason), parsed in the JVM."""
    header = _header_of(_split_record(header_line, delimiter))
    d = "\\" + delimiter if not delimiter.isalnum() else delimiter
    blank = "[ ]" if delimiter == "\t" else "[ \\t]"
    # What is left after taking out well-formed quoted fields must not open a quote again.
    rest = F.regexp_replace("raw", rf'(^|{d}){blank}*"[^"]*+(?:""[^"]*+)*+"{blank}*(?={d}|$)', "$1")
    malformed = F.col("raw").contains('"') & rest.rlike(rf'(^|{d}){blank}*"')
    names = [f"c{i}" for i in range(len(header))]
    ddl = ", ".join(f"{n} string" for n in [*names, "_corrupt"])
    parsed = F.from_csv(
        "raw", ddl,
        {"sep": delimiter, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true",
         "ignoreTrailingWhiteSpace": "true", "columnNameOfCorruptRecord": "_corrupt", "maxCharsPerColumn": "-1"},
    )
    why = F.when(malformed, F.lit(QUOTE_REASON)).when(F.col("r._corrupt").isNotNull(), F.lit(WIDTH_REASON))
    rows = lines.withColumn("r", parsed).select(
        "src_id", "block", F.lit("").alias("sub_id"), "line",
        F.array(*[F.coalesce(F.col(f"r.{n}"), F.lit("")) for n in names]).alias("vals"),
        F.coalesce("reason", why).alias("reason"),
    )
    kw = dict(kw)
    uri_options = kw.pop("uri_options")
    return _documents(rows, _document_columns(header, **kw), kw["doc_type"], uri_options, kw["generate_uri"])
