"""Choosing documents. Predicates on URI, type and stamps reach the Parquet scan."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import local_path
from docspark.functions.uri import directory_prefix


def in_collections(names: list[str]) -> Column:
    return F.arrays_overlap("collections", F.array(*[F.lit(n) for n in names]))


def in_directories(directories: list[str]) -> Column:
    """Under any of the directories, at any depth."""
    return reduce(Column.__or__, [F.col("uri").startswith(directory_prefix(d)) for d in directories])


def of_types(types: list[str]) -> Column:
    return F.upper("content_type").isin(*[t.upper() for t in types])


def selected_by(xpath: str) -> Column:
    """XML documents for which the path holds; others are not parsed."""
    return F.when(F.col("content_type") == "XML", F.xpath_boolean("text", F.lit(local_path(xpath)))).otherwise(F.lit(False))


def filter_collections(docs: DataFrame, names: list[str]) -> DataFrame:
    return docs.where(in_collections(names))


def filter_directories(docs: DataFrame, directories: list[str]) -> DataFrame:
    return docs.where(in_directories(directories))


def filter_types(docs: DataFrame, types: list[str]) -> DataFrame:
    return docs.where(of_types(types))


def filter_selector(docs: DataFrame, xpath: str) -> DataFrame:
    return docs.where(selected_by(xpath))


def filter_visible(docs: DataFrame) -> DataFrame:
    """Live documents: created and not deleted."""
    return docs.where((F.col("created_ts") != 0) & (F.col("deleted_ts") == -1))


def filter_snapshot(docs: DataFrame, ts: int) -> DataFrame:
    """Documents as they stood at one timestamp."""
    return docs.where(
        (F.col("created_ts") != 0)
        & (F.col("created_ts") <= ts)
        & ((F.col("deleted_ts") == -1) | (F.col("deleted_ts") > ts))
    )


def filter_empty(docs: DataFrame, content: str = "text") -> DataFrame:
    """Documents with content; one by reference has some."""
    some = F.length(content) > 0
    return docs.where(some | F.col("ref").isNotNull() if "ref" in docs.columns else some)


def mark_fragments(docs: DataFrame, kind: str = "kind") -> DataFrame:
    """Fragments and links are no documents of their own: mark them as skipped."""
    reason = F.when(F.col(kind) == "fragment", F.lit("fragment")).when(F.col(kind) == "link", F.lit("link"))
    return docs.withColumn("skip_reason", reason)


def reject_split(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents to write, rejected records with source, line and reason)."""
    rejected = docs.where(F.col("skip_reason").isNotNull()).select("src_id", "sub_id", "line", "col", "skip_reason")
    return docs.where(F.col("skip_reason").isNull()), rejected


# A search predicate is a Column; these build its leaves.

_LEFT, _RIGHT, _GAP = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])", r"[^\p{L}\p{N}]+"


def word(term: str, text: str = "text") -> Column:
    """The whole text contains the word, whatever its case."""
    return F.lower(text).rlike(_LEFT + re.escape(term.lower()) + _RIGHT)


def phrase(terms: str, text: str = "text") -> Column:
    """The words follow each other, with only separators between them."""
    parts = [re.escape(t) for t in re.findall(r"\w+", terms.lower())]
    return F.lower(text).rlike(_LEFT + _GAP.join(parts) + _RIGHT)


def value(column: str, wanted) -> Column:
    return F.col(column) == F.lit(wanted)


def between(column: str, low=None, high=None) -> Column:
    out = F.lit(True)
    if low is not None:
        out = out & (F.col(column) >= F.lit(low))
    if high is not None:
        out = out & (F.col(column) <= F.lit(high))
    return out


def all_of(*queries: Column) -> Column:
    return reduce(Column.__and__, queries)


def any_of(*queries: Column) -> Column:
    return reduce(Column.__or__, queries)


def none_of(*queries: Column) -> Column:
    return ~any_of(*queries)


def filter_query(docs: DataFrame, query: Column, selector: str | None = None) -> DataFrame:
    """Documents matching a search predicate, and a selector path if given."""
    return docs.where(query if selector is None else query & selected_by(selector))


def scope(
    collections: list[str] | None = None,
    directories: list[str] | None = None,
    selector: str | None = None,
    query: Column | None = None,
    types: list[str] | None = None,
) -> Column:
    """One predicate for a scan. Only one of collections, directories and selector may be given."""
    if sum(x is not None for x in (collections, directories, selector)) > 1:
        raise ValueError("only one of collections, directories and selector may be given")
    parts = []
    if types is not None:
        parts.append(of_types(types))
    if directories is not None:
        parts.append(in_directories(directories))
    if collections is not None:
        parts.append(in_collections(collections))
    if query is not None:
        parts.append(query)
    if selector is not None:
        parts.append(selected_by(selector))
    return all_of(*parts) if parts else F.lit(True)
