"""Nodes, values, key/value pairs and queries over stored documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.text import cast_value, local_path
from docspark.functions.tree import element_markup, element_values, has_element, is_element_path, value_path
from docspark.runtime import ship


def scan_nodes(
    docs: DataFrame, subdoc_xpath: str, selector: str | None = None, namespaces: Mapping[str, str] | None = None
) -> DataFrame:
    """(uri, path, node) of each node the path selects: mark-up of elements, the value of texts and attributes.

    A prefix that ``namespaces`` binds selects elements of that namespace; others are ignored.
    """
    if selector is not None and namespaces:
        docs = docs.where(has_element(F.col("text"), selector, namespaces))
    elif selector is not None:
        docs = docs.where(F.xpath_boolean("text", F.lit(local_path(selector))))
    if is_element_path(subdoc_xpath):
        ship(docs.sparkSession)
        found = element_markup(F.col("text"), subdoc_xpath, namespaces)
    elif namespaces:
        raise ValueError(f"prefixes can be bound in element paths only: {subdoc_xpath}")
    else:
        found = F.xpath("text", F.lit(local_path(subdoc_xpath)))
    nodes = docs.select("uri", F.posexplode(found).alias("i", "node"))
    path = F.concat(F.lit(f"({subdoc_xpath})["), (F.col("i") + 1).cast("string"), F.lit("]"))
    return nodes.select("uri", path.alias("path"), "node")


def scan_values(
    docs: DataFrame, value_xpath: str, kind: str = "text", strict: bool = False, namespaces: Mapping[str, str] | None = None
) -> DataFrame:
    """(uri, pos, value) of typed values of texts, attributes or elements; ``pos`` is the position in the document."""
    if namespaces:
        ship(docs.sparkSession)
        found = element_values(F.col("text"), value_xpath, namespaces)
    else:
        found = F.xpath("text", F.lit(local_path(value_path(value_xpath))))
    values = docs.select("uri", F.posexplode(found).alias("pos", "raw"))
    typed = cast_value(F.col("raw"), kind, strict)
    return values.select("uri", F.col("pos").cast("bigint").alias("pos"), typed.alias("value"))


def scan_key_values(docs: DataFrame, items: Column, key_type: str = "text", value_type: str = "text") -> DataFrame:
    """Consecutive items of each document paired into (key, value); a last odd item has no pair."""
    n = F.floor(F.size("items") / 2).cast("int")
    pairs = F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(F.get("items", i * 2).alias("key"), F.get("items", i * 2 + 1).alias("value")),
        ),
    )
    flat = docs.select("uri", items.alias("items")).select("uri", F.inline(pairs))
    return flat.select(
        "uri",
        cast_value(F.col("key"), key_type, strict=False).alias("key"),
        cast_value(F.col("value"), value_type, strict=False).alias("value"),
    )


def scan_query(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, args: Mapping | None = None
) -> DataFrame:
    """The result of a SQL text; ``{name}`` refers to a table, ``:name`` to an argument (split bounds, say)."""
    return spark.sql(text, args=dict(args or {}), **dict(tables or {}))


def binary_slice(docs: DataFrame, n: int, column: str = "bytes") -> DataFrame:
    """Bytes 1..n of each binary document."""
    return docs.select("uri", F.substring(F.col(column), 1, n).alias("bytes"))


def scan_naked_properties(docs: DataFrame, props: DataFrame) -> DataFrame:
    """Metadata records whose URI has no document."""
    return props.join(docs.select("uri"), "uri", "left_anti")
