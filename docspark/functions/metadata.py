"""Document metadata: collections, permissions, quality, content type, serialised records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.schema import CAPABILITIES, METADATA_COLUMNS

PERMISSION_DDL = "array<struct<role:string,capability:string>>"
METADATA_DDL = (
    "format string, collections array<string>, permissions array<struct<role:string,capability:string>>, "
    "quality int, meta map<string,string>, properties array<struct<name:string,value:string>>, naked boolean"
)

# File suffixes and the content type their mime type falls into.
MIME_SUFFIXES = [
    ("xml", "XML"), ("xsd", "XML"), ("xsl", "XML"), ("xslt", "XML"), ("xhtml", "XML"), ("svg", "XML"),
    ("rdf", "XML"), ("rss", "XML"), ("atom", "XML"), ("json", "JSON"), ("txt", "TEXT"), ("text", "TEXT"),
    ("html", "TEXT"), ("htm", "TEXT"), ("csv", "TEXT"), ("tsv", "TEXT"), ("css", "TEXT"), ("js", "TEXT"),
    ("xqy", "TEXT"), ("sjs", "TEXT"), ("nt", "TEXT"), ("nq", "TEXT"), ("ttl", "TEXT"), ("md", "TEXT"),
    ("pdf", "BINARY"), ("png", "BINARY"), ("jpg", "BINARY"), ("gif", "BINARY"), ("zip", "BINARY"), ("gz", "BINARY"),
]


def suffix_of(uri: Column) -> Column:
    return F.lower(F.regexp_extract(uri, r"\.([^./]*)$", 1))


def content_type_of(uri: Column, overrides: dict[str, str] | None = None) -> Column:
    """Type of a MIXED document by its suffix, BINARY when the suffix is unknown.

    The map is a constant in the plan; for a caller's own large table use ``operators.joins.broadcast_lookup``.
    """
    pairs = {**dict(MIME_SUFFIXES), **(overrides or {})}
    lookup = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, suffix_of(uri)), F.lit("BINARY"))


def select_metadata(
    df: DataFrame, collections=True, permissions=True, properties=True, quality=True, metadata=True
) -> DataFrame:
    """Keep only the wanted metadata columns; the dropped ones are never read from storage."""
    keep = {
        "collections": collections,
        "permissions": permissions,
        "properties": properties,
        "quality": quality,
        "meta": metadata,
    }
    return df.drop(*[c for c in METADATA_COLUMNS if not keep[c]])


def merge_collections(stored: Column, configured: Column) -> Column:
    """Union without duplicates or empty names, sorted."""
    empty = F.expr("cast(array() as array<string>)")
    both = F.array_union(F.coalesce(configured, empty), F.coalesce(stored, empty))
    return F.array_sort(F.filter(both, lambda x: x.isNotNull() & (x != "")))


def parse_permissions(text: Column) -> Column:
    """``role,capability,role,capability`` to structs; malformed lists raise."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x))
    n = F.size(parts)
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest((n / 2).cast("int") - 1, F.lit(0))),
        lambda i: F.struct(
            F.get(parts, i * 2).alias("role"), F.lower(F.get(parts, i * 2 + 1)).alias("capability")
        ),
    )
    bad = (
        F.when((n % 2) != 0, F.lit("permissions need pairs of role and capability"))
        .when(F.exists(pairs, lambda p: F.coalesce(p["role"], F.lit("")) == ""), F.lit("empty role"))
        .when(
            F.exists(pairs, lambda p: ~F.coalesce(p["capability"], F.lit("")).isin(*CAPABILITIES)),
            F.lit("unknown capability"),
        )
    )
    return (
        F.when(text.isNull() | (text == ""), F.expr(f"cast(array() as {PERMISSION_DDL})"))
        .when(bad.isNotNull(), F.raise_error(F.concat(bad, F.lit(": "), text)).cast(PERMISSION_DDL))
        .otherwise(pairs)
    )


def merge_permissions(
    stored: Column, configured: Column, naked: Column, node_update_supported: bool = False
) -> Column:
    """Set union, sorted; node-update is dropped from naked records when it is not supported."""
    empty = F.expr(f"cast(array() as {PERMISSION_DDL})")
    both = F.array_union(F.coalesce(configured, empty), F.coalesce(stored, empty))
    if not node_update_supported:
        both = F.when(
            F.coalesce(naked, F.lit(False)), F.filter(both, lambda p: p["capability"] != "node-update")
        ).otherwise(both)
    return F.array_sort(both)


def default_quality(stored: Column, configured: int = 0) -> Column:
    """The configured quality wins unless it is 0."""
    return F.lit(configured) if configured != 0 else F.coalesce(stored, F.lit(0))


def metadata_to_json(content_type: Column | str = "content_type") -> Column:
    """Serialise the metadata columns of a document row to one archive entry."""
    ct = F.col(content_type) if isinstance(content_type, str) else content_type
    return F.to_json(
        F.struct(ct.alias("format"), *[F.col(c) for c in METADATA_COLUMNS], F.col("naked")),
        {"ignoreNullFields": "false"},
    )


def metadata_from_json(text: Column) -> Column:
    return F.from_json(text, METADATA_DDL)


def add_collection(collections: Column, names: Sequence[Column]) -> Column:
    return merge_collections(collections, F.array(*names))
