"""N-Triples, N-Quads and RDF/JSON to a triple table."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.rdf import NQUAD, XSD_STRING, blank_node_iri, is_blank_label, resource, unescape
from docspark.functions.uri import whole_match
from docspark.runtime import materialize, maybe_broadcast
from docspark.sources.files import list_files, text_lines
from docspark.sources.json_blocks import read_members
from docspark.sources.numbering import number_in_split
from docspark.sources.xml_blocks import block_size
from docspark.sources.zipped import entry_rows, stream_records

# File suffix to line syntax.
LINE_SUFFIXES = {"nt": "ntriples", "nq": "nquads"}
JSON_SUFFIXES = ("rj", "json")
BAD_LINE = "invalid statement"


def parse_statements(lines: DataFrame, salt: str = "", quads: bool | Column = True) -> DataFrame:
    """Triples of lines (src_id, sub_id, line, value). Comments and blank lines are dropped; a line that is
    no statement stays with a ``skip_reason``, as does one that brings a ``reason``. ``quads`` tells, for all lines or
    each, whether a fourth term may stand."""
    known = F.col("reason") if "reason" in lines.columns else F.lit(None).cast("string")
    blank = F.col("value").isNull() | F.col("value").rlike(r"^\s*(#.*)?$")
    lines = lines.withColumn("_known", known).withColumn("_quads", quads if isinstance(quads, Column) else F.lit(quads))
    lines = lines.where(~blank | F.col("_known").isNotNull())
    # one match per line gives all four terms, set apart by a character that the line does not hold; without a match
    # the line stays whole, and is one piece
    mark = "\u0001"
    at_once = F.split(F.regexp_replace("value", NQUAD, mark.join(["$1", "$2", "$3", "$4"])), mark)
    one_by_one = F.array(*[F.regexp_extract("value", NQUAD, i) for i in range(1, 5)])
    found = F.when(F.col("value").contains(mark), one_by_one).otherwise(F.when(F.size(at_once) == 4, at_once))
    lines = lines.withColumn("_terms", found)

    def term(i: int) -> Column:
        return F.coalesce(F.get("_terms", F.lit(i - 1)), F.lit(""))

    df = lines.select("src_id", "sub_id", "line", "value", "_known", "_quads", *[term(i).alias(f"t{i}") for i in range(1, 5)])
    file = F.concat_ws("/", "src_id", "sub_id")
    o = F.col("t3")
    literal = o.startswith('"')
    lexical = F.regexp_extract(o, r'(?s)^"(.*)"(?:@[^"]*|\^\^<[^"]*>)?$', 1)
    lang = F.nullif(F.regexp_extract(o, r'"@([A-Za-z0-9\-]+)$', 1), F.lit(""))
    datatype = F.nullif(F.regexp_extract(o, r'"\^\^<([^"]*)>$', 1), F.lit(""))
    bad = F.col("_known").isNotNull() | (F.col("t1") == "") | (~F.col("_quads") & (F.col("t4") != ""))
    ok = ~bad
    return df.select(
        F.when(ok, resource(F.col("t1"), file, salt)).alias("s"),
        F.when(ok, resource(F.col("t2"), file, salt)).alias("p"),
        F.when(ok, F.when(literal, unescape(lexical)).otherwise(resource(o, file, salt))).alias("o"),
        F.when(ok, F.when(literal, "literal").when(is_blank_label(o), "blank").otherwise("iri")).alias("o_type"),
        F.when(ok & literal, F.when(lang.isNull(), F.coalesce(datatype, F.lit(XSD_STRING)))).alias("datatype"),
        F.when(ok & literal, lang).alias("lang"),
        F.when(ok & (F.col("t4") != ""), resource(F.col("t4"), file, salt)).alias("graph"),
        "src_id", "sub_id", "line",
        F.coalesce("_known", F.when(bad, F.concat(F.lit(BAD_LINE + ": "), F.col("value")))).alias("skip_reason"),
    )


def _lines(spark: SparkSession, paths, pattern: str | None, encoding: str) -> DataFrame:
    lines = number_in_split(text_lines(spark, paths, pattern, encoding))
    return lines.select("src_id", F.lit("").alias("sub_id"), (F.col("block") + F.col("n")).alias("line"), "value")


def read_ntriples(
    spark: SparkSession, paths: str | Sequence[str], salt: str = "", pattern: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """N-Triples, plain or ``.gz``; ``line`` orders the statements of a file."""
    return parse_statements(_lines(spark, paths, pattern, encoding), salt, quads=False)


def read_nquads(
    spark: SparkSession, paths: str | Sequence[str], salt: str = "", pattern: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """N-Quads, plain or ``.gz``; ``graph`` is null where the line has none."""
    return parse_statements(_lines(spark, paths, pattern, encoding), salt)


def _json_pieces(spark: SparkSession, paths, pattern: str | None, size: int | None) -> DataFrame:
    """(src_id, value, bad): small files whole, large ones as objects of some subjects each."""
    size = size or block_size(spark)
    listed = list_files(spark, paths, pattern)
    if listed.isEmpty():
        raise FileNotFoundError(f"no file below {paths} matches {pattern or 'any name'}")
    packed = F.lower("src_id").endswith(".gz")
    large = listed.where(~packed & (F.col("bytes_n") > size)).select("src_id", "bytes_n")
    files = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    # the length predicate reaches the listing, so that no large file is opened here
    small = (F.col("_metadata.file_size") <= size) | F.lower("_metadata.file_path").endswith(".gz")
    if pattern:
        small = small & F.col("_metadata.file_name").rlike(whole_match(pattern))
    files = files.where(small).select(F.col("_metadata.file_path").alias("src_id"), F.ltrim("value", F.lit("\ufeff")).alias("value"))
    invalid = F.get_json_object("value", "$").isNull()
    files = files.withColumn("bad", invalid)
    if large.isEmpty():
        return files
    pieces = materialize(read_members(large, size).withColumn("bad", F.col("bad") | invalid), "rdf-json")
    bad = maybe_broadcast(pieces.where("bad").select("src_id").distinct())
    fine = pieces.join(bad, "src_id", "left_anti")
    broken = bad.select("src_id", F.lit(None).cast("string").alias("value"), F.lit(True).alias("bad"))
    return files.unionByName(fine).unionByName(broken)


def read_rdf_json(
    spark: SparkSession, paths: str | Sequence[str], salt: str = "", pattern: str | None = None, block: int | None = None
) -> DataFrame:
    """RDF/JSON: subject to predicate to list of objects, one JSON object per file.

    Files of more than ``block`` bytes (a block of the block readers) are read by many tasks, cut between subjects. A file that
    is not JSON gives one reject and no triples.
    """
    df = _json_pieces(spark, paths, pattern, block)
    tree = F.from_json(
        "value", "map<string,map<string,array<struct<value:string,type:string,lang:string,datatype:string>>>>"
    )
    df = df.select("src_id", tree.alias("tree"), "bad")
    good = (
        df.where(~F.col("bad"))
        .select("src_id", F.explode("tree").alias("s", "ps"))
        .select("src_id", "s", F.explode("ps").alias("p", "os"))
        .select("src_id", "s", "p", F.inline("os"))
    )

    def named(term: Column) -> Column:
        return F.when(is_blank_label(term), blank_node_iri(F.substr(term, F.lit(3)), F.col("src_id"), salt)).otherwise(term)

    literal = F.col("type") == "literal"
    lang = F.nullif(F.col("lang"), F.lit(""))
    triples = good.select(
        named(F.col("s")).alias("s"),
        F.col("p"),
        F.when(literal, F.col("value")).otherwise(named(F.col("value"))).alias("o"),
        F.when(literal, "literal").when(F.col("type") == "bnode", "blank").otherwise("iri").alias("o_type"),
        F.when(literal & lang.isNull(), F.coalesce("datatype", F.lit(XSD_STRING))).alias("datatype"),
        F.when(literal, lang).alias("lang"),
        F.lit(None).cast("string").alias("graph"),
        "src_id",
        F.lit("").alias("sub_id"),
        F.lit(0).cast("bigint").alias("line"),
        F.lit(None).cast("string").alias("skip_reason"),
    )
    rejected = df.where("bad").select("src_id", F.lit("invalid JSON").alias("skip_reason"))
    return triples.unionByName(rejected, allowMissingColumns=True)


def _escaped(text: str) -> str:
    """A literal's text as it stands between quotes in a statement."""
    for plain, mark in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = text.replace(plain, mark)
    return text


def _statements_of(tree: dict) -> Iterator[str]:
    """The statements of an RDF/JSON tree as lines."""

    def name(term: str) -> str:
        return term if term.startswith("_:") else f"<{term}>"

    for subject, properties in tree.items():
        for predicate, objects in properties.items():
            for o in objects:
                if o["type"] == "literal":
                    tag = f"@{o['lang']}" if o.get("lang") else f"^^<{o['datatype']}>" if o.get("datatype") else ""
                    term = f'"{_escaped(o["value"])}"{tag}'
                else:
                    term = name(o["value"])
                yield f"{name(subject)} {name(predicate)} {term} ."


def _parse_entry(stream, src_id: str, entry: str) -> Iterator[tuple]:
    """(line, value, whether quads may stand, reason) of an entry, by its suffix."""
    suffix = entry.rpartition(".")[2].lower()
    if suffix in LINE_SUFFIXES:
        for n, line in enumerate(stream, 1):
            yield n, line.decode("UTF-8", "replace").rstrip("\r\n"), suffix == "nq", None
    elif suffix in JSON_SUFFIXES:
        try:
            for n, line in enumerate(_statements_of(json.loads(stream.read())), 1):
                yield n, line, False, None
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            yield 0, None, False, f"invalid RDF/JSON: {e}"
    else:
        yield 0, None, False, f"no reader for entries that end in .{suffix}"


def read_rdf_zip(spark: SparkSession, paths: str | Sequence[str], salt: str = "", pattern: str | None = None) -> DataFrame:
    """Statements of the entries of zips, each read by its own suffix in one pass; other entries are rejected."""
    lines = stream_records(
        entry_rows(spark, paths, pattern), _parse_entry, "line bigint, value string, quads boolean, reason string",
        lambda why: (0, None, False, why),
    )
    return parse_statements(lines, salt, F.col("quads"))
