"""Redaction by a table of rules."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.spans import IN_DOUBLE, IN_SINGLE, JSON_STEP, JSON_STRING, XML_TEXT, json_edits, xml_edits
from docspark.functions.tree import is_element_path
from docspark.runtime import ship

KINDS = ("mask", "regex", "hash", "conceal")


def _mask(c: Column, rule: dict) -> Column:
    char = rule.get("char", "#")
    return F.mask(c, F.lit(char), F.lit(char), F.lit(char))


def _expression(c: Column, rule: dict) -> Column:
    kind = rule["kind"]
    if kind == "mask":
        return _mask(c, rule)
    if kind == "regex":
        return F.regexp_replace(c, F.lit(rule["pattern"]), F.lit(rule.get("replacement", "")))
    if kind == "hash":
        return F.sha2(F.concat(F.lit(rule.get("salt", "")), c), 256)
    return F.lit(None).cast("string")


def _type_of(path: str) -> str:
    """Type of the documents a rule's path is for; a path that cannot be followed is an error."""
    element, _, attribute = path.partition("/@")
    if path[:1] == "/" and is_element_path(element) and (not attribute or re.fullmatch(r"[\w.\-:]+", attribute)):
        return "XML"
    if path[:1] == "$" and len(path) > 1 and JSON_STEP.sub("", path) == "$":
        return "JSON"
    raise ValueError(f"rule path cannot be followed: {path}")


_FOUND = "pieces array<string>, parts array<struct<value: string, form: int, rules: array<int>>>"


def _finder(kind: str, rules: list[tuple]):
    """A column function: what the rules select of each text, and the pieces of the text around it; null if nothing."""
    edits = xml_edits if kind == "XML" else json_edits

    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        found = [None if t is None else edits(t, rules).pieces() for t in texts]
        return pd.DataFrame(
            {
                "pieces": pd.Series([None if f is None else f[0] for f in found], dtype=object),
                "parts": pd.Series([None if f is None else [{"value": v, "form": form, "rules": of} for v, form, of in f[1]] for f in found], dtype=object),
            }
        )

    return find


def _changed(parts: Column, number: int, rule: dict) -> Column:
    def one(x: Column) -> Column:
        mine = F.array_contains(x["rules"], number) & ((x["form"] != XML_TEXT) | (F.trim(x["value"]) != ""))
        value = F.when(mine, F.coalesce(_expression(x["value"], rule), F.lit(""))).otherwise(x["value"])
        return F.struct(value.alias("value"), x["form"].alias("form"), x["rules"].alias("rules"))

    return F.transform(parts, one)


def _escaped(value: Column, *marks: tuple[str, str]) -> Column:
    for plain, mark in (("&", "&amp;"), ("<", "&lt;"), *marks):
        value = F.replace(value, F.lit(plain), F.lit(mark))
    return value


def _written(x: Column) -> Column:
    """A value as it stands in its place."""
    white = ("\n", "&#10;"), ("\t", "&#9;"), ("\r", "&#13;")
    quoted = F.to_json(F.struct(x["value"].alias("v")))
    return (
        F.when(x["form"] == JSON_STRING, F.substr(quoted, F.lit(6), F.length(quoted) - 6))
        .when(x["form"] == IN_DOUBLE, _escaped(x["value"], ('"', "&quot;"), *white))
        .when(x["form"] == IN_SINGLE, _escaped(x["value"], ("'", "&apos;"), *white))
        .otherwise(_escaped(x["value"], (">", "&gt;"), white[2]))
    )


def _in_paths(text: Column, kind: str, rules: list[dict]) -> Column:
    """Apply all rules of one type of documents. A parser finds places and values, once; the JVM changes them."""
    numbered = [(n, r["path"], r["kind"] == "conceal", dict(r.get("namespaces") or {})) for n, r in enumerate(rules)]
    found = _finder(kind, numbered)(text)

    def put(f: Column) -> Column:
        parts = f["parts"]
        for n, rule in enumerate(rules):
            if rule["kind"] != "conceal":
                parts = _changed(parts, n, rule)
        values = F.concat(F.transform(parts, _written), F.array(F.lit("")))
        return F.array_join(F.flatten(F.zip_with(f["pieces"], values, lambda p, v: F.array(p, v))), "")

    # the parser's result stands once in the plan
    whole = F.get(F.transform(F.array(found), lambda f: F.when(f["pieces"].isNull(), F.lit(None).cast("string")).otherwise(put(f))), F.lit(0))
    return F.coalesce(whole, text)


def redact(docs: DataFrame, rules: Iterable[dict], others: str = "raise") -> DataFrame:
    """Apply rules in order. A rule names a ``column``, or a ``path`` in documents, and a ``kind``: ``mask``, ``regex``
    (pattern, replacement), ``hash`` (salt) or ``conceal``.

    A path that begins with ``/`` is for XML: steps of ``/name``, ``//name``, ``*`` and ``[n]``, at the end perhaps
    ``/@name``; prefixes are bound by the rule's ``namespaces``. The rule changes every text below the elements it
    selects. A path that begins with ``$`` is for JSON: ``.name``, ``['name']`` and ``[*]``; the rule changes every
    scalar at or below it. All that is not selected stays byte for byte; a changed element loses the comments and
    processing instructions below it and has double quotes in its start tag, a CDATA section becomes escaped text, and an
    element left without content an empty tag. Nothing passes unseen: a path that cannot be followed, a document that does not parse, and a
    document of a type that no path is for, are errors; ``others="keep"`` lets the last pass.
    """
    rules = list(rules)
    for rule in rules:
        if rule.get("kind") not in KINDS:
            raise ValueError(f"unknown redaction kind {rule.get('kind')}")
        if "path" not in rule and rule.get("column") not in docs.columns:
            raise ValueError(f"rule names no column or path: {rule}")
    if others not in ("raise", "keep"):
        raise ValueError(f"unknown choice {others}")
    covered = sorted({_type_of(rule["path"]) for rule in rules if "path" in rule})
    if covered:
        ship(docs.sparkSession)
    if covered and "ref" in docs.columns:
        stop = F.raise_error(F.concat(F.lit("a document by reference cannot be redacted: "), F.coalesce("uri", F.lit("")))).cast("string")
        docs = docs.withColumn("text", F.when(F.col("ref").isNotNull(), stop).otherwise(F.col("text")))
    if covered and others == "raise":
        kind = F.coalesce(F.col("content_type"), F.lit("no type"))
        message = F.concat(F.lit(f"redaction rules are for {' and '.join(covered)}, but a document is of "), kind)
        stop = F.col("text").isNotNull() & ~kind.isin(*covered)
        docs = docs.withColumn("text", F.when(stop, F.raise_error(message).cast("string")).otherwise(F.col("text")))
    # rules of one type of documents that follow each other are applied together
    for of, some in groupby(rules, key=lambda r: _type_of(r["path"]) if "path" in r else None):
        if of is not None:
            mine = F.col("content_type") == of
            changed = _in_paths(F.when(mine, F.col("text")), of, list(some))
            docs = docs.withColumn("text", F.when(mine, changed).otherwise(F.col("text")))
            continue
        for rule in some:
            docs = docs.withColumn(rule["column"], _expression(F.col(rule["column"]).cast("string"), rule))
    return docs
