"""Filters and joins over documents derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions.text import hrefs, is_internal_link
from docspark.operators import filters as S
from docspark.operators import joins as J
from docspark.plans.catalog import query
from docspark.plans.derive import (
    STAMPED_ORDERS,
    TEXT_DOCS,
    customer_json,
    customer_statements,
    customer_xml,
    page_docs,
    stamped_orders,
    table,
    text_docs,
)
from docspark.sources.rdf import parse_statements


@query("filter_collections", f"select uri from {TEXT_DOCS} where lang = 'fr' or source = 'src1'")
def q_filter_collections(spark, sf):
    return S.filter_collections(text_docs(spark, sf), ["fr", "src1"]).select("uri")


@query("filter_directories", f"select uri from {TEXT_DOCS} where source in ('src1', 'src3')")
def q_filter_directories(spark, sf):
    return S.filter_directories(text_docs(spark, sf), ["/src1", "/src3/"]).select("uri")


@query("filter_types", "select '/customer/'||c_custkey||'.xml' as uri from customer union all select '/customer/'||c_custkey||'.json' from customer")
def q_filter_types(spark, sf):
    docs = text_docs(spark, sf).unionByName(customer_xml(spark, sf)).unionByName(customer_json(spark, sf))
    return S.filter_types(docs, ["xml", "Json"]).select("uri")


@query("filter_selector", "select '/customer/'||c_custkey||'.xml' as uri from customer where c_nationkey = 7 and c_acctbal > 100")
def q_filter_selector(spark, sf):
    docs = customer_xml(spark, sf).unionByName(text_docs(spark, sf))
    return S.filter_selector(docs, "/customer[c_nationkey = 7 and c_acctbal > 100]").select("uri")


@query(
    "filter_query",
    rf"""select uri from {TEXT_DOCS} where source <> 'src2' and (list_contains(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), 'the')
 or regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}])der[^\p{{L}}\p{{N}}]+und([^\p{{L}}\p{{N}}]|$)')) and length(text) <= 5000""",
)
def q_filter_query(spark, sf):
    docs = text_docs(spark, sf).withColumn("n_chars", F.length("text"))
    wanted = S.all_of(
        S.none_of(S.in_collections(["src2"])), S.any_of(S.word("The"), S.phrase("der und")), S.between("n_chars", high=5000)
    )
    return S.filter_query(docs, wanted).select("uri")


@query("filter_visible", f"select o_orderkey from {STAMPED_ORDERS} where created_ts <> 0 and deleted_ts = -1")
def q_filter_visible(spark, sf):
    return S.filter_visible(stamped_orders(spark, sf)).select(F.col("line").alias("o_orderkey"))


@query("filter_snapshot", f"select o_orderkey from {STAMPED_ORDERS} where created_ts <> 0 and created_ts <= 10000 and (deleted_ts = -1 or deleted_ts > 10000)")
def q_filter_snapshot(spark, sf):
    return S.filter_snapshot(stamped_orders(spark, sf), 10000).select(F.col("line").alias("o_orderkey"))


@query("filter_fragments", "select o_orderkey, case o_orderstatus when 'P' then 'fragment' when 'O' then 'link' end as skip_reason from orders")
def q_filter_fragments(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "P", "fragment").when(F.col("o_orderstatus") == "O", "link").otherwise("document")
    nodes = table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))
    return S.mark_fragments(nodes).select("o_orderkey", "skip_reason")


@query("filter_empty", "select c_custkey from customer where c_acctbal >= 0")
def q_filter_empty(spark, sf):
    text = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))
    return S.filter_empty(table(spark, sf, "customer").select("c_custkey", text.alias("text"))).select("c_custkey")


_HREFS = """(select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages)"""
_INTERNAL = "href not like '#%' and href not like 'http://%' and href not like 'File:%' and href not like 'Image:%'"


@query("filter_links", f"select page_id, href from {_HREFS} where {_INTERNAL}")
def q_filter_links(spark, sf):
    links = page_docs(spark, sf).select(F.col("line").alias("page_id"), F.explode(hrefs(F.col("text"))).alias("href"))
    return links.where(is_internal_link(F.col("href")))


@query("reject_split", "select 'customer' as src_id, c_custkey as line, 'Value '||c_name||' is not type NUMBER' as skip_reason from customer where c_acctbal < 0")
def q_reject_split(spark, sf):
    docs = customer_xml(spark, sf).withColumn("balance", F.xpath_double("text", F.lit("/customer/c_acctbal")))
    name = F.xpath_string("text", F.lit("/customer/c_name"))
    bad = F.concat(F.lit("Value "), name, F.lit(" is not type NUMBER"))
    docs = docs.withColumn("skip_reason", F.when(F.col("balance") < 0, bad)).drop("balance")
    return S.reject_split(docs)[1].select("src_id", "line", "skip_reason")


@query(
    "join_doc_metadata",
    "select doc_id, md5(text) as text_md5, quality, toxic from documents left join labels using (doc_id)",
)
def q_join_doc_metadata(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return J.join_doc_metadata(docs, table(spark, sf, "labels"), "doc_id")


@query("anti_naked", "select doc_id, quality from labels where doc_id not in (select doc_id from documents where lang = 'en')")
def q_anti_naked(spark, sf):
    docs = table(spark, sf, "documents").where("lang = 'en'")
    return J.anti_naked(table(spark, sf, "labels").select("doc_id", "quality"), docs, "doc_id")


@query("semi_existing", "select doc_id, quality from labels where doc_id in (select doc_id from documents where lang = 'fr')")
def q_semi_existing(spark, sf):
    docs = table(spark, sf, "documents").where("lang = 'fr'")
    return J.semi_existing(table(spark, sf, "labels").select("doc_id", "quality"), docs, "doc_id")


@query(
    "left_graph_permissions",
    """select 'urn:nation:'||c_nationkey as graph, case when n_regionkey = 1 then n_name else 'default' end as role
 from (select distinct c_nationkey from customer) join nation on n_nationkey = c_nationkey""",
)
def q_left_graph_permissions(spark, sf):
    name = F.col("n_name").alias("role")
    stored = table(spark, sf, "nation").where("n_regionkey = 1").select(
        F.format_string("urn:nation:%d", "n_nationkey").alias("graph"),
        F.array(F.struct(name, F.lit("read").alias("capability"))).alias("permissions"),
    )
    graphs = table(spark, sf, "customer").select(F.format_string("urn:nation:%d", "c_nationkey").alias("graph")).distinct()
    default = F.array(F.struct(F.lit("default").alias("role"), F.lit("read").alias("capability")))
    joined = J.left_graph_permissions(graphs, stored, default)
    return joined.select("graph", F.col("permissions")[0]["role"].alias("role"))


def _triples(spark, sf):
    lines = customer_statements(spark, sf).select(
        F.lit("customer").alias("src_id"), F.lit("").alias("sub_id"), F.col("c_custkey").alias("line"), "value"
    )
    return parse_statements(lines)


@query(
    "anti_new_graphs",
    """select distinct 'urn:nation:'||c_nationkey as graph from customer
 where c_nationkey not in (select n_nationkey from nation where n_regionkey < 3)""",
)
def q_anti_new_graphs(spark, sf):
    stored = table(spark, sf, "nation").where("n_regionkey < 3").select(F.format_string("urn:nation:%d", "n_nationkey").alias("graph"))
    return J.anti_new_graphs(_triples(spark, sf).where(F.col("graph").isNotNull()), stored)


@query("broadcast_lookup", "select c_custkey, n_name from customer left join nation on n_nationkey = c_nationkey")
def q_broadcast_lookup(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.broadcast_lookup(c, names, "c_nationkey").select("c_custkey", "n_name")


@query("union_inputs", f"select uri from {TEXT_DOCS} union all select '/pages/'||page_id||'.html' from pages")
def q_union_inputs(spark, sf):
    return text_docs(spark, sf).unionByName(page_docs(spark, sf)).select("uri")
