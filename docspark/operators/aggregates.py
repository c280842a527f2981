"""The classic map and reduce jobs over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.metadata import merge_collections
from docspark.functions.text import is_internal_link, local_path, xml_text
from docspark.runtime import maybe_broadcast, with_positions

CHUNK = 1000
# Bytes that a document counts for at least when parts are filled.
SHARE = 1 << 16


def link_count(docs: DataFrame, links: Column) -> DataFrame:
    """References per link target; ``links`` is an array of targets per document."""
    titles = docs.select(F.explode(links).alias("title")).where(is_internal_link(F.col("title")))
    return titles.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


def link_count_pairs(docs: DataFrame, pairs: Column) -> DataFrame:
    """References per title from an array of (href, title), counting only internal hrefs."""
    rows = docs.select(F.inline(pairs)).where(is_internal_link(F.col("href"), F.col("title")))
    return rows.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


def link_count_values(lexicon: DataFrame) -> DataFrame:
    """References per title from a value lexicon (term, freq)."""
    kept = lexicon.where(is_internal_link(F.col("term")))
    return kept.groupBy(F.col("term").alias("title")).agg(F.sum("freq").alias("n"))


def link_count_files(xml_docs: DataFrame, element: str = "//a", href: str = "href", title: str = "title") -> DataFrame:
    """References per title over XML files: the elements at a path that have both attributes are the links."""
    both = f"{local_path(element)}[@{href} and @{title}]"
    names, targets = (F.xpath("text", F.lit(f"{both}/@{a}")) for a in (title, href))
    return link_count_pairs(xml_docs, F.arrays_zip(targets.alias("href"), names.alias("title")))


def link_count_ops(counts: DataFrame, base_uri: str, root_path: str) -> DataFrame:
    """Node operations writing each sum as child ``ref-count`` of the document named after the title."""
    named = counts.where(F.trim("title") != "")
    return named.select(
        F.concat(F.lit(base_uri), F.trim("title")).alias("uri"),
        F.lit(root_path).alias("path"),
        F.lit("insert-child").alias("op"),
        F.concat(F.lit("<ref-count>"), F.col("n").cast("string"), F.lit("</ref-count>")).alias("xml"),
        F.lit(0).alias("seq"),
    )


def link_count_properties(counts: DataFrame, base_uri: str) -> DataFrame:
    """Property operations writing each sum as property ``ref-count``."""
    return counts.where(F.trim("title") != "").select(
        F.concat(F.lit(base_uri), F.trim("title")).alias("uri"),
        F.lit("ref-count").alias("name"),
        F.col("n").cast("string").alias("value"),
        F.lit(0).alias("seq"),
    )


def year_collections(docs: DataFrame, year: Column, key: str = "uri") -> DataFrame:
    """(uri, collections to add): the distinct years of each document."""
    return (
        docs.select(key, year.cast("string").alias("_y"))
        .where(F.col("_y").isNotNull())
        .groupBy(key)
        .agg(F.array_sort(F.collect_set("_y")).alias("added"))
    )


def add_collections(docs: DataFrame, added: DataFrame, key: str = "uri") -> DataFrame:
    """Add collections (uri, added) to the documents they name."""
    merged = merge_collections(F.col("collections"), F.col("added"))
    return docs.join(maybe_broadcast(added), key, "left").withColumn("collections", merged).drop("added")


def group_by_year(docs: DataFrame, revisions: DataFrame, ts: str = "ts") -> DataFrame:
    """The year of each revision (uri, ts) becomes a collection of its document."""
    return add_collections(docs, year_collections(revisions, F.year(ts)))


def join_sorted(rows: DataFrame, group: list[str], value: str, separator: str = " ", chunk: int = CHUNK) -> DataFrame:
    """All values of a group in ascending order, joined; one row per ``chunk`` values.

    Reading the parts of a group in order gives the whole text. Equal values are counted before the sort, so
    it moves one row per distinct value; a value found often is cut over as many parts as it fills.
    """
    counted = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_positions(counted, [value], group, "_first", weight="_n")
    first, last = F.col("_first") - 1, F.col("_first") + F.col("_n") - 2
    parts = ranked.select(
        *group, value, first.alias("_from"), last.alias("_to"),
        F.explode(F.sequence(F.floor(first / chunk), F.floor(last / chunk))).alias("part"),
    )
    begin = F.greatest(F.col("_from"), F.col("part") * chunk)
    end = F.least(F.col("_to"), (F.col("part") + 1) * chunk - 1)
    pieces = parts.select(*group, "part", begin.alias("_at"), F.col(value).alias("_v"), (end - begin + 1).cast("int").alias("_k"))
    out = pieces.groupBy(*group, "part").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_v", "_k"))).alias("_e"), F.sum("_k").cast("bigint").alias("n")
    )
    repeated = F.flatten(F.transform("_e", lambda e: F.array_repeat(e["_v"], e["_k"])))
    return out.select(*group, "part", "n", F.array_join(repeated, separator).alias("words"))


def first_words(docs: DataFrame, group: list[str], text: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """First word of each document, sorted and joined, per group and part."""
    body = xml_text(F.col("text")) if text is None else text
    rows = docs.select(*group, F.split(body, " ", 2)[0].alias("word"))
    return join_sorted(rows, group, "word", " ", chunk)


def concat_archive(docs: DataFrame, group: list[str], order: list[str], text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Documents of a group wrapped in ``<archives>``, in parts to be read in order.

    A part takes at most ``chunk`` documents, and ends with the one that makes it ``chunk`` times ``SHARE`` bytes.
    """
    body = F.regexp_replace(text, r"^\s*<\?xml[^>]*\?>", "")
    weight = F.greatest(F.octet_length("_body").cast("bigint"), F.lit(SHARE))
    sized = docs.select(*group, *order, body.alias("_body")).withColumn("_weight", weight)
    rows = with_positions(sized, order, group, "_rank", weight="_weight")
    part = F.floor((F.col("_rank") - 1) / (chunk * SHARE)).cast("bigint")
    out = rows.groupBy(*group, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_body"))).alias("_e"), F.count(F.lit(1)).alias("n")
    )
    items = F.transform("_e", lambda e: F.concat(F.lit("<archive>\n"), e["_body"], F.lit("</archive>\n")))
    return out.select(
        *group, "part", "n", F.concat(F.lit("<archives>"), F.array_join(items, ""), F.lit("</archives>")).alias("archive")
    )


def regroup_docs(docs: DataFrame, types: list[str] | None = None) -> DataFrame:
    """(uri, content): one document per URI, binaries left out; the last of several by (src_id, line)."""
    kept = docs.where(F.col("content_type").isin(*types) if types else F.col("content_type") != "BINARY")
    return kept.groupBy("uri").agg(F.max_by("text", F.struct("src_id", "line")).alias("text"))
