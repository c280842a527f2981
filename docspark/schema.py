"""The document table: one row per document, whatever it was read from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERMISSION = T.StructType([T.StructField("role", T.StringType()), T.StructField("capability", T.StringType())])
PROPERTY = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])

DOC_SCHEMA = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("collections", T.ArrayType(T.StringType())),
        T.StructField("permissions", T.ArrayType(PERMISSION)),
        T.StructField("quality", T.IntegerType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("properties", T.ArrayType(PROPERTY)),
        T.StructField("naked", T.BooleanType()),
        T.StructField("src_id", T.StringType()),
        T.StructField("sub_id", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("skip_reason", T.StringType()),
        T.StructField("created_ts", T.LongType()),
        T.StructField("deleted_ts", T.LongType()),
        # how the bytes lie in src_id, for documents too large for a row
        T.StructField("ref", T.StringType()),
    ]
)

# Values used when a source says nothing about a column.
_DEFAULTS = {
    "collections": "array()",
    "permissions": "array()",
    "quality": "0",
    "meta": "map()",
    "properties": "array()",
    "naked": "false",
    "sub_id": "''",
    "line": "0",
    "col": "0",
    "created_ts": "1",
    "deleted_ts": "-1",
}

METADATA_COLUMNS = ("collections", "permissions", "quality", "meta", "properties")
CAPABILITIES = ("read", "execute", "insert", "update", "node-update")
CONTENT_TYPES = ("XML", "JSON", "TEXT", "BINARY", "UNKNOWN", "MIXED")


def to_docs(df: DataFrame, **given: Column | str) -> DataFrame:
    """Project ``df`` onto the document schema, filling absent columns with their defaults."""
    have = set(df.columns)
    out = []
    for f in DOC_SCHEMA.fields:
        if f.name in given:
            c = given[f.name]
            c = F.col(c) if isinstance(c, str) else c
        elif f.name in have:
            c = F.col(f.name)
        else:
            c = F.expr(_DEFAULTS.get(f.name, "null"))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def node_content_type(kind: Column) -> Column:
    """Content type of a stored node, by the kind of its root node."""
    k = F.lower(kind)
    return (
        F.when(k.isin("document", "element"), "XML")
        .when(k == "text", "TEXT")
        .when(k == "binary", "BINARY")
        .when(k.isin("array", "object", "number", "boolean", "null"), "JSON")
        .otherwise("UNKNOWN")
    )
