"""Lexicons: the distinct terms of documents with their frequencies.

All take the same path: an array of terms per document, made distinct inside the row, exploded and filtered,
then a partial count per task before the shuffle, so that a term found everywhere costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import local_path, matches, words
from docspark.functions.tree import value_path
from docspark.runtime import with_positions


def lexicon(
    docs: DataFrame,
    terms: Column,
    restrict: Column | None = None,
    start=None,
    pattern: str | None = None,
    offset: int = 0,
    limit: int | None = None,
    frequency: str = "fragment",
    descending: bool = False,
    sort: bool = True,
) -> DataFrame:
    """(term, freq) of an array column. ``freq`` is the number of documents, or with ``frequency="item"``
    the number of occurrences. ``start`` keeps terms from there on, ``pattern`` is a wildcard, ``offset``
    and ``limit`` take a positional range of the sorted terms."""
    if frequency not in ("fragment", "item"):
        raise ValueError(f"unknown frequency {frequency}")
    if restrict is not None:
        docs = docs.where(restrict)
    term = F.col("term")
    kept = term.isNotNull()
    if start is not None:
        kept = kept & ((term <= F.lit(start)) if descending else (term >= F.lit(start)))
    if pattern is not None and pattern != "*":
        kept = kept & matches(term, pattern)
    # After the explode these tests are compiled; inside the array they would be interpreted per element. The
    # outer form keeps Spark from adding a size test that would evaluate a costly array twice.
    found = F.explode_outer(F.array_distinct(terms) if frequency == "fragment" else terms)
    out = docs.select(found.alias("term")).where(kept).groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    return page_terms(out, ["term"], offset, limit, descending, sort)


def page_terms(
    terms: DataFrame, order: list[str], offset: int = 0, limit: int | None = None, descending=False, sort=True
) -> DataFrame:
    """Terms in order, with ``offset`` skipped and cut after ``limit``.

    An offset is a range of positions, found by a range sort: no task sees all terms.
    """
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    if offset:
        placed = with_positions(terms, by, name="_pos").where(F.col("_pos") > offset)
        if limit is not None:
            placed = placed.where(F.col("_pos") <= offset + limit)
        return placed.drop("_pos").orderBy(*by) if sort else placed.drop("_pos")
    if sort or limit is not None:
        terms = terms.orderBy(*by)
    return terms if limit is None else terms.limit(limit)


def xpath_terms(path: str, text: str = "text") -> Column:
    """Values at an XML path; elements give their text."""
    return F.xpath(text, F.lit(local_path(value_path(path))))


def element_path(names: list[str]) -> str:
    return "|".join(f"//{n}/text()" for n in names)


def attribute_path(elements: list[str], attributes: list[str]) -> str:
    return "|".join(f"//{e}/@{a}" for e in elements for a in attributes)


def words_of(values: Column) -> Column:
    """Words of an array of texts."""
    return F.flatten(F.transform(values, words))


def uris(docs: DataFrame, **kw) -> DataFrame:
    """The URI lexicon: URIs are keys, so there is nothing to count or shuffle before the sort."""
    restrict, start, pattern = kw.get("restrict"), kw.get("start"), kw.get("pattern")
    out = docs if restrict is None else docs.where(restrict)
    if start is not None:
        out = out.where(F.col("uri") >= F.lit(start))
    if pattern is not None:
        out = out.where(matches(F.col("uri"), pattern))
    out = out.select(F.col("uri").alias("term"), F.lit(1).cast("bigint").alias("freq"))
    return page_terms(out, ["term"], kw.get("offset", 0), kw.get("limit"), sort=kw.get("sort", True))


def collections(docs: DataFrame, **kw) -> DataFrame:
    return lexicon(docs, F.col("collections"), **kw)


def word_lexicon(docs: DataFrame, **kw) -> DataFrame:
    return lexicon(docs, words(F.col("text")), **kw)


def path_values(docs: DataFrame, path: str, **kw) -> DataFrame:
    """Values at an XML path, or at a JSON path starting with ``$``."""
    if path.startswith("$"):
        return lexicon(docs, F.array(F.get_json_object("text", path)), **kw)
    return lexicon(docs, xpath_terms(path), **kw)


def element_values(docs: DataFrame, names: list[str], **kw) -> DataFrame:
    return lexicon(docs, xpath_terms(element_path(names)), **kw)


def element_words(docs: DataFrame, names: list[str], **kw) -> DataFrame:
    return lexicon(docs, words_of(xpath_terms(element_path(names))), **kw)


def attribute_values(docs: DataFrame, elements: list[str], attributes: list[str], **kw) -> DataFrame:
    return lexicon(docs, xpath_terms(attribute_path(elements, attributes)), **kw)


def attribute_words(docs: DataFrame, elements: list[str], attributes: list[str], **kw) -> DataFrame:
    return lexicon(docs, words_of(xpath_terms(attribute_path(elements, attributes))), **kw)


def field_terms(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def field_values(docs: DataFrame, columns: list[str], **kw) -> DataFrame:
    """A named field is a list of columns; its values are those of any of them."""
    return lexicon(docs, field_terms(columns), **kw)


def field_words(docs: DataFrame, columns: list[str], **kw) -> DataFrame:
    parts = [F.coalesce(words(F.col(c).cast("string")), F.expr("array()")) for c in columns]
    return lexicon(docs, reduce(lambda a, b: F.concat(a, b), parts), **kw)
