"""RDF terms, triple documents and graph rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

XSD_STRING = "http://www.w3.org/2001/XMLSchema#string"
DEFAULT_GRAPH = "urn:docspark:default-graph"
BLANK_BASE = "urn:docspark:blank/"
SEM_NAMESPACE = "urn:docspark:semantics"

_IRI = r"<[^<>\"{}|^`\x00-\x20]*>"
_BLANK = r"_:[^\s<>\"]+?"
_LITERAL = r'"(?:[^"\\\r\n]|\\.)*+"(?:@[A-Za-z]+(?:-[A-Za-z0-9]+)*|\^\^' + _IRI + ")?"
NQUAD = (
    rf"^\s*({_IRI}|{_BLANK})\s*({_IRI})\s*({_IRI}|{_BLANK}|{_LITERAL})"
    rf"(?:\s*({_IRI}|_:[^\s<>\"]+?))?\s*\.\s*(?:#.*)?$"
)

TRIPLE_DDL = (
    "s string, p string, o string, o_type string, datatype string, lang string, graph string"
)


def is_blank_label(term: Column) -> Column:
    return term.startswith("_:")


def blank_node_iri(label: Column, file: Column, salt: str) -> Column:
    """IRI of a blank node: the same label of the same file gives the same IRI within one run."""
    return F.concat(F.lit(BLANK_BASE), F.lower(F.hex(F.xxhash64(F.lit(salt), file, label))))


def unescape(lexical: Column) -> Column:
    """Resolve the string escapes of a literal or IRI."""
    quoted = F.concat(F.lit('{"v":"'), F.replace(lexical, F.lit("\\'"), F.lit("'")), F.lit('"}'))
    return F.when(lexical.contains("\\"), F.from_json(quoted, "v string", {"allowUnquotedControlChars": "true"})["v"]).otherwise(lexical)


def resource(term: Column, file: Column, salt: str) -> Column:
    """IRI of a subject, predicate, graph or non-literal object as written in the line."""
    iri = unescape(F.regexp_extract(term, r"^<(.*)>$", 1))
    return F.when(is_blank_label(term), blank_node_iri(F.substr(term, F.lit(3)), file, salt)).otherwise(iri)


def escape_xml(text: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.coalesce(text, F.lit(""))


def triple_to_xml(s: Column, p: Column, o: Column, o_type: Column, datatype: Column, lang: Column) -> Column:
    """One triple element. A language tag excludes a datatype; a plain literal is an xs:string."""
    has_lang = F.coalesce(lang, F.lit("")) != ""
    attrs = (
        F.when(o_type != "literal", F.lit(""))
        .when(has_lang, F.concat(F.lit(" xml:lang='"), escape_xml(lang), F.lit("'")))
        .otherwise(
            F.concat(F.lit(" datatype='"), escape_xml(F.coalesce(datatype, F.lit(XSD_STRING))), F.lit("'"))
        )
    )
    return F.concat(
        F.lit("<sem:triple><sem:subject>"), escape_xml(s),
        F.lit("</sem:subject><sem:predicate>"), escape_xml(p),
        F.lit("</sem:predicate><sem:object"), attrs, F.lit(">"), escape_xml(o),
        F.lit("</sem:object></sem:triple>"),
    )


def triples_document(triples: Column, namespace: str = SEM_NAMESPACE) -> Column:
    """Document text around an array of triple elements."""
    return F.concat(
        F.lit(f'<sem:triples xmlns:sem="{namespace}">'), F.array_join(triples, ""), F.lit("</sem:triples>")
    )


def resolve_graph(
    quad: Column,
    override_graph: str | None = None,
    output_graph: str | None = None,
    collections: list[str] | None = None,
    default: str = DEFAULT_GRAPH,
) -> Column:
    """Graph of a triple. An override, or collections without an output graph, ignore the quad's own graph;
    else the quad's graph counts, then the output graph, then the default."""
    if override_graph is not None and output_graph is not None:
        raise ValueError("only one of override_graph and output_graph may be given")
    if override_graph is not None:
        return F.lit(override_graph)
    if collections and output_graph is None:
        return F.lit(collections[0])
    return F.coalesce(F.nullif(quad, F.lit("")), F.lit(output_graph or default))


def graph_collections(graph: Column, collections: list[str] | None = None) -> Column:
    """Collections of a packed triple document: its graph and the configured ones."""
    extra = [F.lit(c) for c in collections or []]
    return F.array_distinct(F.array(graph, *extra))
