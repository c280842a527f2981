"""Changes inside stored documents: nodes at a path, and properties."""

from __future__ import annotations

from xml.dom import minidom

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.tree import select, written
from docspark.operators.aggregates import add_collections
from docspark.runtime import maybe_broadcast, ship

NODE_OPS = ("insert-before", "insert-after", "insert-child", "replace")


def _apply(text: str, ops: list[dict]) -> str:
    document = minidom.parseString(text.encode("utf-8"))
    for op in ops:
        for target in select(document, op["path"]):
            fragment = minidom.parseString(f"<f>{op['xml']}</f>".encode()).documentElement
            nodes = [document.importNode(c, True) for c in fragment.childNodes]
            if op["op"] == "insert-child":
                for node in nodes:
                    target.appendChild(node)
                continue
            parent = target.parentNode
            if parent is document:
                if op["op"] != "replace":
                    raise ValueError("a document has one root element")
                nodes = [n for n in nodes if n.nodeType == n.ELEMENT_NODE][:1]
            before = target.nextSibling if op["op"] == "insert-after" else target
            if op["op"] == "replace":
                before = target.nextSibling
                parent.removeChild(target)
            for node in nodes:
                parent.insertBefore(node, before)
    return written(document, text)


_EDITED = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_EDITED)
def _edit(texts: pd.Series, ops: pd.Series) -> pd.DataFrame:
    out = []
    for text, todo in zip(texts, ops):
        if text is None:
            out.append((None, None))
            continue
        try:
            out.append((_apply(text, sorted(todo, key=lambda o: o["seq"])), None))
        except Exception as e:  # a failed edit is reported with its document and must not stop the load
            out.append((text, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(out, columns=["text", "error"])


def apply_node_ops(docs: DataFrame, ops: DataFrame) -> DataFrame:
    """Apply (uri, path, op, xml, seq) to the XML documents they name, in ``seq`` order.

    A document is one row and holds all that is inserted into it, so its operations meet in one row, too.
    Operations on unknown documents have no effect; a failed edit leaves the text as it was and sets
    ``skip_reason``.
    """
    ship(docs.sparkSession)
    bad = ~F.col("op").isin(*NODE_OPS)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("unsupported operation "), F.col("op")))).otherwise(F.col("op"))
    grouped = ops.groupBy("uri").agg(
        F.array_sort(F.collect_list(F.struct("seq", "path", checked.cast("string").alias("op"), "xml"))).alias("_ops")
    )
    todo = F.col("_ops").isNotNull()
    # only documents with operations send their text to Python
    edited = docs.join(maybe_broadcast(grouped), "uri", "left").withColumn("_r", _edit(F.when(todo, F.col("text")), "_ops"))
    edited = edited.withColumn("text", F.when(todo, F.col("_r.text")).otherwise(F.col("text")))
    if "skip_reason" in docs.columns:
        edited = edited.withColumn("skip_reason", F.coalesce("skip_reason", F.col("_r.error")))
    return edited.select(*docs.columns)


def apply_property_ops(docs: DataFrame, ops: DataFrame, add: bool = False, always_create: bool = False) -> DataFrame:
    """Set or add properties (uri, name, value, seq) of the documents they name.

    Set replaces the property of that name (the last by ``seq`` wins), add appends. Operations on unknown
    documents have no effect unless ``always_create``, which makes metadata-only records.
    """
    if add:
        merged = ops.groupBy("uri").agg(F.array_sort(F.collect_list(F.struct("seq", "name", "value"))).alias("_new"))
    else:
        # one value per name first, so that repeated updates of one property never pile up
        last = ops.groupBy("uri", "name").agg(F.max_by("value", "seq").alias("value"))
        merged = last.groupBy("uri").agg(
            F.array_sort(F.collect_list(F.struct(F.lit(0).alias("seq"), "name", "value"))).alias("_new")
        )
    pairs = F.transform("_new", lambda p: F.struct(p["name"].alias("name"), p["value"].alias("value")))
    merged = merged.select("uri", pairs.alias("_new"))
    joined = docs.join(merged, "uri", "full") if always_create else docs.join(maybe_broadcast(merged), "uri", "left")
    old = F.coalesce("properties", F.expr("cast(array() as array<struct<name:string,value:string>>)"))
    if not add:
        names = F.transform("_new", lambda p: p["name"])
        old = F.filter(old, lambda p: ~F.array_contains(names, p["name"]))
    out = joined.withColumn("properties", F.when(F.col("_new").isNull(), F.col("properties")).otherwise(F.concat(old, "_new")))
    if always_create and "naked" in docs.columns:
        out = out.withColumn("naked", F.coalesce("naked", F.lit(True)))
    return out.select(*docs.columns)


def add_collection_to(docs: DataFrame, keyed: DataFrame) -> DataFrame:
    """Add a collection to each document named by rows (uri, collection)."""
    added = keyed.groupBy("uri").agg(F.array_sort(F.collect_set("collection")).alias("added"))
    return add_collections(docs, added).select(*docs.columns)
