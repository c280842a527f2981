"""Newline-delimited JSON."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.uri import filename_of, uri_build, uri_generate
from docspark.runtime import ship
from docspark.schema import to_docs
from docspark.sources.files import text_lines
from docspark.sources.numbering import number_in_split
from docspark.sources.zipped import entry_rows, stream_records

NO_URI = "the line names no URI"


def _scalar_text(value) -> str | None:
    """Text of a JSON scalar as the JVM prints it; null for booleans, nulls and containers."""
    if isinstance(value, float):
        d = Decimal(repr(value))
        if value == 0 or 1e-3 <= abs(value) < 1e7:
            return format(d, "f") if "." in format(d, "f") else format(d, "f") + ".0"
        digits = "".join(map(str, d.as_tuple().digits)).rstrip("0")
        return f"{'-' if value < 0 else ''}{digits[0]}.{digits[1:] or '0'}E{d.adjusted()}"
    if isinstance(value, str) or (isinstance(value, int) and not isinstance(value, bool)):
        return str(value)
    return None


def _find(line: str, name: str) -> str | None:
    """First property ``name`` breadth-first; an object or array there ends the search without a value."""
    queue = deque([_loads(line)])
    while queue:
        node = queue.popleft()
        if isinstance(node, dict):
            if name in node:
                return _scalar_text(node[name])
            queue.extend(v for v in node.values() if isinstance(v, dict | list))
        elif isinstance(node, list):
            queue.extend(v for v in node if isinstance(v, dict | list))
    return None


def _loads(line: str):
    """The JSON value of a line, None if it is none; a repeated key keeps its last value."""

    def refuse(constant: str):
        raise ValueError(constant)

    try:
        return json.loads(line, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None


def _doubtful(text: Column) -> Column:
    """Lines the variant parser refuses but another parser reads: repeated keys, great length, loose syntax."""
    return F.try_parse_json(text).isNull() & F.get_json_object(text, "$").isNotNull()


def uri_from_json_bfs(text: Column, name: str) -> Column:
    """Value of the shallowest property ``name`` anywhere in the JSON; null if absent or not a scalar.

    A property at the top level, the common case, is read in the JVM; only other lines go to Python.
    """
    parsed = F.try_parse_json(text)
    simple = name.isidentifier()
    kind = F.lit(None).cast("string")
    top = F.lit(None).cast("string")
    if simple:
        kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant"))
        top = F.try_variant_get(parsed, f"$.{name}", "string")
    in_jvm = F.coalesce(kind.isin("STRING", "BIGINT"), F.lit(False))

    @F.pandas_udf("string")
    def search(lines: pd.Series) -> pd.Series:
        return lines.map(lambda line: None if line is None else _find(line, name))

    ask = F.when(~in_jvm & text.contains(name) & (parsed.isNotNull() | _doubtful(text)), text)
    return F.when(in_jvm, top).otherwise(search(ask))


def _line_reason(line: Column) -> Column:
    blank = F.trim(F.translate(line, "\t\r\f", "   ")) == ""
    return F.when(blank, F.lit("empty lines")).when(
        line.startswith(" ") | line.startswith("\t"), F.lit("leading space")
    )


def _json_reason(line: Column) -> Column:
    @F.pandas_udf("boolean")
    def is_json(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: x is not None and _loads(x) is not None)

    doubtful = _doubtful(line)
    # only doubtful lines go to Python
    valid = F.when(doubtful, is_json(F.when(doubtful, line))).otherwise(F.try_parse_json(line).isNotNull())
    return F.when(~(valid & line.rlike(r"^[\[{]")), F.lit("invalid JSON"))


def _to_documents(
    df: DataFrame, uri_id: str | None, filename_as_collection: bool, collection: Column, uri_options: dict
) -> DataFrame:
    """Documents of (src_id, sub_id, line, block, n, value, skip_reason)."""
    if uri_id is None:
        raw = uri_generate(F.concat_ws("/", "src_id", F.nullif(F.col("sub_id"), F.lit(""))), F.col("block"), F.col("n"))
    else:
        raw = uri_from_json_bfs(F.when(F.col("skip_reason").isNull(), F.col("value")), uri_id)
    df = df.withColumn("_raw", raw)
    missing = F.when(F.col("_raw").isNull(), F.lit(NO_URI))
    uri, uri_reason = uri_build(F.col("_raw"), **uri_options)
    df = df.withColumn("skip_reason", F.coalesce("skip_reason", missing, uri_reason)).withColumn("_uri", uri)
    ok = F.col("skip_reason").isNull()
    return to_docs(
        df,
        uri=F.when(ok, F.col("_uri")),
        text=F.when(ok, F.col("value")),
        content_type=F.lit("JSON"),
        collections=F.array(collection) if filename_as_collection else F.expr("array()"),
    )


def read_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    uri_id: str | None = None,
    pattern: str | None = None,
    filename_as_collection: bool = False,
    encoding: str = "UTF-8",
    **uri_options,
) -> DataFrame:
    """One JSON value per line as one document each; ``.gz`` files are decompressed by the reader.

    Without ``uri_id`` URIs are generated from the file split and line. Files are cut into blocks at line ends.
    ``line`` is the block's start plus the number in the block: it rises inside a file, and is the line's number in
    files of one block.
    """
    lines = text_lines(spark, paths, pattern, encoding)
    return documents_of_lines(lines, uri_id, filename_as_collection, **uri_options)


def documents_of_lines(
    lines: DataFrame, uri_id: str | None = None, filename_as_collection: bool = False, **uri_options
) -> DataFrame:
    """Documents of lines (value, src_id, block) as a text reader gives them."""
    ship(lines.sparkSession)
    df = lines.withColumn("skip_reason", _line_reason(F.col("value")))
    df = number_in_split(df, name="line")
    if uri_id is None:
        df = number_in_split(df.withColumn("_counts", F.col("skip_reason").isNull()), name="n", counted="_counts")
    else:
        df = df.withColumn("n", F.lit(0))
    df = df.withColumn("line", F.col("block") + F.col("line")).withColumn("sub_id", F.lit(""))
    df = df.withColumn("skip_reason", F.coalesce("skip_reason", _json_reason(F.col("value"))))
    return _to_documents(df, uri_id, filename_as_collection, filename_of(F.col("src_id")), uri_options)


def _parse_lines(encoding: str):
    def parse(stream, src_id: str, entry: str) -> Iterator[tuple]:
        n = 0
        for number, raw in enumerate(stream, 1):
            line = raw.decode(encoding).rstrip("\r\n")
            n += bool(line.strip()) and line[0] not in " \t"
            yield number, n, line, None

    return parse


def read_ndjson_zip(
    spark: SparkSession,
    paths: str | Sequence[str],
    uri_id: str | None = None,
    pattern: str | None = None,
    encoding: str = "UTF-8",
    filename_as_collection: bool = False,
    **uri_options,
) -> DataFrame:
    """Lines of zip entries; with ``filename_as_collection`` the collection is ``archive_entry``."""
    rows = stream_records(
        entry_rows(spark, paths, pattern), _parse_lines(encoding),
        "line bigint, n bigint, value string, skip_reason string", lambda why: (0, 0, None, why),
    )
    value = F.col("value")
    reason = F.coalesce("skip_reason", _line_reason(value), _json_reason(value))
    df = rows.withColumn("skip_reason", reason).withColumn("block", F.lit(0))
    collection = F.concat_ws("_", filename_of(F.col("src_id")), F.col("sub_id"))
    return _to_documents(df, uri_id, filename_as_collection, collection, uri_options)
