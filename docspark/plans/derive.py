"""Documents, files and triples derived from the given tables."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.build import row_to_json, row_to_xml
from docspark.operators.graphs import pack
from docspark.runtime import spread_small, work_path
from docspark.schema import to_docs
from docspark.sinks.export import export_files, export_zip

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
RECORDS_PER_FILE = 500


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """A table for work that is heavy per row."""
    t = table(spark, sf, name)
    return spread_small(t.select(*columns) if columns else t)


def text_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(spark, sf, "documents", "doc_id", "text", "lang", "source")
    uri = F.concat(F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return to_docs(
        d,
        uri=uri, content_type=F.lit("TEXT"), collections=F.array("lang", "source"), src_id=F.lit("documents"), line="doc_id",
    )


# The same documents in SQL.
TEXT_DOCS = "(select '/'||source||'/'||doc_id||'.txt' as uri, doc_id, text, lang, source, n_chars from documents)"


def page_docs(spark: SparkSession, sf: str) -> DataFrame:
    p = spread(spark, sf, "pages")
    return to_docs(
        p, uri=F.concat(F.lit("/pages/"), F.col("page_id").cast("string"), F.lit(".html")),
        content_type=F.lit("TEXT"), text="html", src_id="url", line="page_id",
    )


def customer_columns() -> dict[str, Column]:
    return {c: F.col(c) for c in CUSTOMER}


def customer_xml(spark: SparkSession, sf: str) -> DataFrame:
    c = spread(spark, sf, "customer")
    return to_docs(
        c, uri=F.concat(F.lit("/customer/"), F.col("c_custkey").cast("string"), F.lit(".xml")),
        content_type=F.lit("XML"), text=row_to_xml(customer_columns(), "customer"),
        collections=F.array("c_mktsegment"), src_id=F.lit("customer"), line="c_custkey",
    )


CUSTOMER_ROW = (
    "'<c_custkey><![CDATA['||c_custkey||']]></c_custkey><c_name><![CDATA['||c_name||']]></c_name>"
    "<c_nationkey><![CDATA['||c_nationkey||']]></c_nationkey><c_acctbal><![CDATA['||c_acctbal||']]></c_acctbal>"
    "<c_mktsegment><![CDATA['||c_mktsegment||']]></c_mktsegment>'"
)
CUSTOMER_XML = f"('<customer>'||{CUSTOMER_ROW}||'</customer>')"


def customer_json(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    body, reason = row_to_json(customer_columns(), {"c_custkey": "Number", "c_nationkey": "Number", "c_acctbal": "Number"})
    return to_docs(
        c, uri=F.concat(F.lit("/customer/"), F.col("c_custkey").cast("string"), F.lit(".json")),
        content_type=F.lit("JSON"), text=body, skip_reason=reason, src_id=F.lit("customer"), line="c_custkey",
    )


def tagged_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as XML with attributes: ``<customer nation=".." segment=".."><name>..</name></customer>``."""
    c = spread(spark, sf, "customer")
    text = F.format_string(
        '<customer nation="%d" segment="%s"><name>%s</name><note lang="en">%s in nation %d</note></customer>',
        "c_nationkey", "c_mktsegment", "c_name", "c_mktsegment", "c_nationkey",
    )
    uri = F.concat(F.lit("/tagged/"), F.col("c_custkey").cast("string"), F.lit(".xml"))
    return to_docs(c, uri=uri, content_type=F.lit("XML"), text=text, src_id=F.lit("customer"), line="c_custkey")


def linked_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as XML pages that link to their nation, their segment and outside."""
    c = spread(spark, sf, "customer").join(
        table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    )
    text = F.format_string(
        '<page><title>%s</title><a href="/nation/%d" title="%s"/><a href="File:%s" title="%s"/>'
        '<a href="http://example.org/%d" title="out"/></page>',
        "c_name", "c_nationkey", "n_name", "c_mktsegment", "c_mktsegment", "c_nationkey",
    )
    uri = F.concat(F.lit("/linked/"), F.col("c_custkey").cast("string"), F.lit(".xml"))
    return to_docs(c, uri=uri, content_type=F.lit("XML"), text=text, src_id=F.lit("customer"), line="c_custkey")


@F.pandas_udf(T.BinaryType())
def gzip_bytes(data: pd.Series) -> pd.Series:
    return data.map(lambda x: gzip.compress(x.encode("utf-8") if isinstance(x, str) else bytes(x), mtime=0))


def gzipped(docs: DataFrame) -> DataFrame:
    """The same documents as gzip files."""
    return (
        docs.withColumn("bytes", gzip_bytes("text"))
        .withColumn("text", F.lit(None).cast("string"))
        .withColumn("content_type", F.lit("BINARY"))
        .withColumn("uri", F.concat("uri", F.lit(".gz")))
    )


def packed_files(rows: DataFrame, line: Column, order: list[str], head: str, tail: str, suffix: str, separator: str = "\n") -> DataFrame:
    """Documents that hold up to RECORDS_PER_FILE lines of ``rows`` each, between ``head`` and ``tail``."""
    packed = pack(rows, line, order, [], RECORDS_PER_FILE)
    text = F.concat(F.lit(head), F.array_join("items", separator), F.lit(tail))
    return to_docs(
        packed, uri=F.concat(F.lit("/part-"), F.col("part").cast("string"), F.lit(suffix)),
        content_type=F.lit("TEXT"), text=text,
    )


def as_files(docs: DataFrame, name: str) -> str:
    path = work_path(docs.sparkSession, name)
    export_files(docs, path)
    return path


def as_zips(docs: DataFrame, name: str) -> str:
    path = work_path(docs.sparkSession, name)
    export_zip(docs, path)
    return path


def csv_line(columns: list[str]) -> Column:
    """One CSV line, every field quoted."""
    quoted = [
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in columns
    ]
    return F.concat_ws(",", *quoted)


def csv_dir(df: DataFrame, name: str, **options) -> str:
    path = work_path(df.sparkSession, name)
    df.write.options(header="true", escape='"', **options).csv(path)
    return path


def text_dir(df: DataFrame, line: Column, name: str, **options) -> str:
    path = work_path(df.sparkSession, name)
    df.select(line.alias("value")).write.options(**options).text(path)
    return path


def customer_statements(spark: SparkSession, sf: str, quads: bool = True) -> DataFrame:
    """(c_custkey, value): three statements per customer, with a plain, a tagged and a typed literal."""
    c = table(spark, sf, "customer")
    subject = F.format_string("<urn:customer:%d>", "c_custkey")
    graph = F.format_string(" <urn:nation:%d>", "c_nationkey") if quads else F.lit("")
    lines = F.array(
        F.concat(subject, F.lit(' <urn:p:name> "'), "c_name", F.lit('"'), graph, F.lit(" .")),
        F.concat(subject, F.lit(' <urn:p:segment> "'), "c_mktsegment", F.lit('"@en'), graph, F.lit(" . # segment")),
        F.concat(
            subject, F.lit(' <urn:p:balance> "'), F.col("c_acctbal").cast("string"),
            F.lit('"^^<http://www.w3.org/2001/XMLSchema#double>'), F.lit(" ."),
        ),
    )
    return c.select("c_custkey", F.explode(lines).alias("value"))


# The triples of those statements in SQL.
XSD = "http://www.w3.org/2001/XMLSchema#"
CUSTOMER_TRIPLES = f"""(
 select 'urn:customer:'||c_custkey as s, 'urn:p:name' as p, c_name as o, '{XSD}string' as datatype, '' as lang, 'urn:nation:'||c_nationkey as graph from customer
 union all select 'urn:customer:'||c_custkey, 'urn:p:segment', c_mktsegment, '', 'en', 'urn:nation:'||c_nationkey from customer
 union all select 'urn:customer:'||c_custkey, 'urn:p:balance', c_acctbal::varchar, '{XSD}double', '', '' from customer)"""


def flat_triples(triples: DataFrame) -> DataFrame:
    empty = F.lit("")
    return triples.select(
        "s", "p", "o", F.coalesce("datatype", empty).alias("datatype"), F.coalesce("lang", empty).alias("lang"),
        F.coalesce("graph", empty).alias("graph"),
    )


def stamped_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents with creation and deletion stamps (days since 1970) and a node kind."""
    o = table(spark, sf, "orders")
    day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    life = (F.col("o_custkey") % 90) + 1
    return to_docs(
        o, uri=F.concat(F.lit("/orders/"), F.col("o_orderkey").cast("string"), F.lit(".json")),
        content_type=F.lit("JSON"), text=F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")),
        created_ts=F.when(F.col("o_orderpriority").startswith("4"), 0).otherwise(day),
        deleted_ts=F.when(F.col("o_orderstatus") == "F", day + life).otherwise(-1),
        src_id=F.lit("orders"), line="o_orderkey",
    )


STAMPED_ORDERS = """(select o_orderkey,
 case when o_orderpriority like '4%' then 0 else date_diff('day', date '1970-01-01', o_orderdate::date) end as created_ts,
 case when o_orderstatus = 'F' then date_diff('day', date '1970-01-01', o_orderdate::date) + o_custkey % 90 + 1 else -1 end as deleted_ts
 from orders)"""
