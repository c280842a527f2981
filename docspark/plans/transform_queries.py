"""User transforms and redaction over documents derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.operators import transform as T
from docspark.operators.redact import redact
from docspark.plans.catalog import query
from docspark.plans.derive import TEXT_DOCS, customer_xml, table, tagged_customers, text_docs


@query("transform_docs", f"select uri||'.new' as uri, md5(text||'!') as text_md5, null::varchar as skip_reason from {TEXT_DOCS}")
def q_transform_docs(spark, sf):
    def mark(content, context):
        return {"uri": content["uri"] + ".new", "value": content["value"] + context["transform_param"]}

    docs = T.transform_docs(text_docs(spark, sf), mark, param="!")
    return docs.select("uri", F.md5("text").alias("text_md5"), "skip_reason")


@query("transform_column", f"select uri, md5(upper(source)||text) as text_md5 from {TEXT_DOCS}")
def q_transform_column(spark, sf):
    text = F.concat(F.upper(F.get("collections", 1)), "text")
    return T.transform_column(text_docs(spark, sf), text).select("uri", F.md5("text").alias("text_md5"))


@query(
    "transform_one_to_many",
    """select '/customer/'||c_custkey||'.xml' as uri, c_name as value from customer
 union all select '/customer/'||c_custkey||'.xml/segment', c_mktsegment from customer""",
)
def q_transform_one_to_many(spark, sf):
    many = F.array(
        F.struct(F.col("uri"), F.xpath_string("text", F.lit("/customer/c_name")).alias("text")),
        F.struct(F.concat("uri", F.lit("/segment")).alias("uri"), F.xpath_string("text", F.lit("/customer/c_mktsegment")).alias("text")),
    )
    return T.transform_one_to_many(customer_xml(spark, sf), many).select("uri", F.col("text").alias("value"))


@query(
    "transform_one_to_many_fn",
    f"select uri||'/'||n as uri, case n when 1 then md5(text) else md5(lang) end as text_md5 from {TEXT_DOCS}, (values (1), (2)) t(n)",
)
def q_transform_one_to_many_fn(spark, sf):
    docs = text_docs(spark, sf).select("uri", F.concat_ws("|", F.get("collections", 0), "text").alias("text"), "skip_reason")

    def split(content, context):
        lang, _, text = content["value"].partition("|")
        return [{"uri": content["uri"] + "/1", "value": text}, {"uri": content["uri"] + "/2", "value": lang}]

    return T.transform_docs(docs, split).select("uri", F.md5("text").alias("text_md5"))


@query(
    "transform_rename_elements",
    """select '/tagged/'||c_custkey||'.xml' as uri, '<CUSTOMER nation="'||c_nationkey||'" segment="'||c_mktsegment||'"><NAME>'||c_name||'</NAME><NOTE lang="en">'
 ||c_mktsegment||' in nation '||c_nationkey||'</NOTE></CUSTOMER>' as text from customer""",
)
def q_transform_rename_elements(spark, sf):
    return T.transform_rename_elements(tagged_customers(spark, sf), upper=True).select("uri", "text")


@query(
    "redact",
    """select c_custkey as line, regexp_replace(c_name, '[0-9]', '#', 'g') as name, sha256('salt'||c_mktsegment) as segment,
 '' as balance, 'nation '||regexp_replace(c_nationkey::varchar, '[0-9]', 'N', 'g') as nation from customer""",
)
def q_redact(spark, sf):
    """Rules on elements of XML documents: mask, hash, conceal and replace."""
    rules = [
        {"path": "/customer/c_name", "kind": "regex", "pattern": "[0-9]", "replacement": "#"},
        {"path": "/customer/c_mktsegment", "kind": "hash", "salt": "salt"},
        {"path": "/customer/c_acctbal", "kind": "conceal"},
        {"path": "//c_nationkey", "kind": "regex", "pattern": "^([0-9]+)$", "replacement": "nation $1"},
        {"path": "//c_nationkey", "kind": "regex", "pattern": "[0-9]", "replacement": "N"},
    ]
    docs = redact(customer_xml(spark, sf), rules)

    def at(name):
        return F.xpath_string("text", F.lit(f"/customer/{name}")).alias(name[2:])

    return docs.select(
        "line", at("c_name"), F.xpath_string("text", F.lit("/customer/c_mktsegment")).alias("segment"),
        F.xpath_string("text", F.lit("/customer/c_acctbal")).alias("balance"),
        F.xpath_string("text", F.lit("/customer/c_nationkey")).alias("nation"),
    )


@query(
    "redact_columns",
    """select c_custkey, regexp_replace(c_name, '[A-Za-z0-9]', '#', 'g') as c_name, null::varchar as c_mktsegment, sha256(c_nationkey::varchar) as c_nationkey from customer""",
)
def q_redact_columns(spark, sf):
    rules = [
        {"column": "c_name", "kind": "mask"},
        {"column": "c_mktsegment", "kind": "conceal"},
        {"column": "c_nationkey", "kind": "hash"},
    ]
    return redact(table(spark, sf, "customer"), rules).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
