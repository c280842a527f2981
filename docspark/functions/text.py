"""Words, wildcards, links, casts and XML text."""

from __future__ import annotations

import re
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """All words of the whole text, lower-cased: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def wildcard_regex(pattern: str) -> str:
    """``*`` is any text, ``?`` one character; everything else is literal, the whole term must match."""
    body = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern)
    return f"(?s)^{body}$"


def matches(term: Column, pattern: str) -> Column:
    """Wildcard match; a plain prefix becomes startswith, which Parquet can prune on."""
    if pattern == "*":
        return term.isNotNull()
    if pattern.endswith("*") and not re.search(r"[*?]", pattern[:-1]):
        return term.startswith(pattern[:-1])
    return term.rlike(wildcard_regex(pattern))


def hrefs(html: Column) -> Column:
    """Values of all href attributes of a page."""
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))


def anchors(html: Column) -> Column:
    """(href, title) of each anchor: the title is the anchor's text."""
    pairs = F.regexp_extract_all(html, F.lit('(<a href="[^"]*">[^<]*</a>)'), F.lit(1))
    return F.transform(
        pairs,
        lambda a: F.struct(
            F.regexp_extract(a, 'href="([^"]*)"', 1).alias("href"),
            F.regexp_extract(a, ">([^<]*)<", 1).alias("title"),
        ),
    )


def is_internal_link(href: Column, value: Column | None = None) -> Column:
    """Links that name another document: no anchors, no external, file or image links."""
    # Prefixes of links that do not count as references.
    ok = href.isNotNull()
    for prefix in ("#", "http://", "File:", "Image:"):
        ok = ok & ~href.startswith(prefix)
    return ok & value.isNotNull() if value is not None else ok


def local_path(path: str) -> str:
    """An XML path without prefixes. Spark's xpath matches local names and knows no prefix bindings."""
    parts = re.split(r"('[^']*'|\"[^\"]*\")", path)
    plain = [p if i % 2 else re.sub(r"(?<![\w.\-])[A-Za-z_][\w.\-]*:(?=[A-Za-z_*])", "", p) for i, p in enumerate(parts)]
    return "".join(plain)


def _parses(text: str | None) -> bool:
    try:
        expat.ParserCreate("UTF-8").Parse((text or "").encode(), True)
        return True
    except expat.ExpatError:
        return False


def well_formed(xml: Column) -> Column:
    """Whether the text parses as XML. ``xpath`` fails the job on other text. Runs in Python; null is not sent."""

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(_parses)

    return F.when(xml.isNotNull(), check(xml)).otherwise(F.lit(False))


def content_error(content_type: Column, text: Column) -> Column:
    """Why the text is no document of its type, or null: XML and JSON must parse."""
    is_xml = content_type == "XML"
    bad_xml = ~well_formed(F.when(is_xml, text))
    bad_json = F.get_json_object(text, "$").isNull()
    return (
        F.when(is_xml & text.isNotNull() & bad_xml, F.lit("malformed XML"))
        .when((content_type == "JSON") & text.isNotNull() & bad_json, F.lit("invalid JSON"))
    )


def xml_text(xml: Column) -> Column:
    """Text of the document element. The XML must be well-formed."""
    return F.xpath_string(xml, F.lit("/*"))


# The scalar types a value query may ask for.
VALUE_TYPES = {
    "text": "string", "int": "int", "vint": "int", "long": "bigint", "vlong": "bigint",
    "boolean": "boolean", "float": "float", "double": "double", "bytes": "binary",
}


def cast_value(value: Column, kind: str, strict: bool = True) -> Column:
    """Typed value of a query result; a value that does not fit raises, or is null if not ``strict``."""
    if kind.lower() not in VALUE_TYPES:
        raise ValueError(f"Value {kind} is not supported")
    target = VALUE_TYPES[kind.lower()]
    if target in ("string", "binary"):
        return value.cast(target)
    out = value.try_cast(target)
    if not strict:
        return out
    message = F.concat(F.lit("cannot convert to "), F.lit(target), F.lit(": "), value.cast("string"))
    return F.when(value.isNotNull() & out.isNull(), F.raise_error(message).cast(target)).otherwise(out)
