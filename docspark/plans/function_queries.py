"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions import metadata as M
from docspark.functions import rdf as R
from docspark.functions import text as X
from docspark.functions import uri as U
from docspark.functions.build import row_to_json, row_to_xml, xml_valid_name
from docspark.plans.catalog import query
from docspark.plans.derive import (
    CUSTOMER_XML,
    TEXT_DOCS,
    as_files,
    customer_columns,
    customer_statements,
    customer_xml,
    table,
    text_docs,
)
from docspark.runtime import with_positions
from docspark.sources.files import read_files
from docspark.sources.ndjson import uri_from_json_bfs
from docspark.sources.rdf import parse_statements


@query(
    "uri_replace",
    rf"select doc_id, regexp_replace(regexp_replace(uri, '^/src(\d+)/', '/source-\1/'), '\.txt$', '.text') as uri from {TEXT_DOCS}",
)
def q_uri_replace(spark, sf):
    option = r"^/src(\d+)/,'/source-$1/',\.txt$,'.text'"
    return text_docs(spark, sf).select(F.col("line").alias("doc_id"), U.uri_replace(F.col("uri"), option).alias("uri"))


@query("uri_prefix_suffix", f"select '/in'||uri||'.bak' as uri from {TEXT_DOCS}")
def q_uri_prefix_suffix(spark, sf):
    return text_docs(spark, sf).select(U.uri_prefix_suffix(F.col("uri"), "/in", ".bak").alias("uri"))


_RAW_PART = "('/'||p_type||'/'||p_name||'#'||p_brand||'?é%')"


@query(
    "uri_encode",
    rf"""select p_partkey, array_to_string(list_transform(string_split({_RAW_PART}, ''), lambda c:
 case when regexp_matches(c, '^[A-Za-z0-9_\-!.~''()*,;:$&+=@/é]$') then c
 else regexp_replace(hex(encode(c)), '(..)', '%\1', 'g') end), '') as uri from part""",
)
def q_uri_encode(spark, sf):
    raw = F.concat(F.lit("/"), "p_type", F.lit("/"), "p_name", F.lit("#"), "p_brand", F.lit("?é%"))
    return table(spark, sf, "part").select("p_partkey", U.uri_encode(raw).alias("uri"))


@query("uri_output_dir", f"select '/out'||uri as uri from {TEXT_DOCS}")
def q_uri_output_dir(spark, sf):
    return text_docs(spark, sf).select(U.uri_output_dir(F.col("uri"), "/out/").alias("uri"))


@query("uri_generate", "select doc_id, source||'-0-'||row_number() over (partition by source order by doc_id) as uri from documents")
def q_uri_generate(spark, sf):
    ranked = with_positions(table(spark, sf, "documents").select("doc_id", "source"), ["doc_id"], ["source"], "n")
    return ranked.select("doc_id", U.uri_generate(F.col("source"), F.lit(0), F.col("n")).alias("uri"))


@query(
    "uri_from_column",
    """select c_custkey, case when c_acctbal >= 0 then '/c/'||replace(c_name, '#', '%23') end as uri,
 case when c_acctbal < 0 then 'empty uri value' end as skip_reason from customer""",
)
def q_uri_from_column(spark, sf):
    raw = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name"))
    uri, reason = U.uri_build(raw, prefix="/c/")
    return table(spark, sf, "customer").select("c_custkey", uri.alias("uri"), reason.alias("skip_reason"))


@query("uri_from_json_bfs", "select event_id, case when event_type <> 'scroll' then json_extract_string(props, '$.k') end as uri from events")
def q_uri_from_json_bfs(spark, sf):
    """Purchases hold the key in a nested array, scrolls as an object, which is no URI."""
    value = F.col("props")
    text = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"x": [1, {"y": null}, '), value, F.lit("]}")))
        .when(F.col("event_type") == "scroll", F.concat(F.lit('{"k": '), value, F.lit("}")))
        .otherwise(value)
    )
    return table(spark, sf, "events").select("event_id", uri_from_json_bfs(text, "k").alias("uri"))


@query("path_from_uri", r"select page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path from pages")
def q_path_from_uri(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.path_from_uri(F.col("url")).alias("path"))


@query("filename_as_collection", "select doc_id||'.txt' as collection, md5(text) as text_md5 from documents")
def q_filename_as_collection(spark, sf):
    path = as_files(text_docs(spark, sf), "files")
    docs = read_files(spark, path, filename_as_collection=True)
    return docs.select(F.get("collections", 0).alias("collection"), F.md5("text").alias("text_md5"))


@query("strip_bom", "select c_custkey, c_name as header from customer")
def q_strip_bom(spark, sf):
    marked = F.concat(F.when(F.col("c_acctbal") > 0, F.lit("﻿")).otherwise(F.lit("")), "c_name")
    return table(spark, sf, "customer").select("c_custkey", U.strip_bom(marked).alias("header"))


@query("xml_valid_name", "select p_partkey, '_'||regexp_replace(p_size||p_name||p_brand, '[^A-Za-z0-9_.:-]', '_', 'g') as name from part")
def q_xml_valid_name(spark, sf):
    header = F.concat(F.col("p_size").cast("string"), "p_name", "p_brand")
    return table(spark, sf, "part").select("p_partkey", xml_valid_name(header).alias("name"))


@query("row_to_xml", f"select c_custkey, {CUSTOMER_XML} as doc from customer")
def q_row_to_xml(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", row_to_xml(customer_columns(), "customer").alias("doc"))


_NUMBER = "case when c_acctbal = floor(c_acctbal) then c_acctbal::bigint::varchar else c_acctbal::varchar end"


@query(
    "row_to_json",
    f"""select c_custkey, case when c_acctbal > 0 or c_nationkey > 12 then '{{"c_name":"'||c_name||'","c_acctbal":'||{_NUMBER}||case when c_nationkey > 12 then '' else ',"flag":true' end||'}}' end as doc,
 case when c_acctbal <= 0 and c_nationkey <= 12 then 'Value odd is not type BOOLEAN' end as skip_reason from customer""",
)
def q_row_to_json(spark, sf):
    """A bad Boolean is a reason, an empty one leaves its key out."""
    flag = F.when(F.col("c_nationkey") > 12, "").when(F.col("c_acctbal") > 0, "true").otherwise("odd")
    columns = {"c_name": F.col("c_name"), "c_acctbal": F.col("c_acctbal"), "flag": flag}
    doc, reason = row_to_json(columns, "c_acctbal,Number,flag,Boolean")
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(reason.isNull(), doc).alias("doc"), reason.alias("skip_reason")
    )


@query(
    "content_type_of",
    """select event_id, case event_type when 'click' then 'XML' when 'error' then 'JSON' when 'view' then 'TEXT' else 'BINARY' end as content_type from events""",
)
def q_content_type_of(spark, sf):
    kind = F.col("event_type")
    suffix = F.when(kind == "click", ".xml").when(kind == "error", ".JSON").when(kind == "view", ".txt").otherwise(".unknown")
    uri = F.concat(F.lit("/e/"), F.col("event_id").cast("string"), suffix)
    return table(spark, sf, "events").select("event_id", M.content_type_of(uri).alias("content_type"))


@query("select_metadata", f"select uri, 3 as quality from {TEXT_DOCS}")
def q_select_metadata(spark, sf):
    docs = text_docs(spark, sf).withColumn("quality", F.lit(3)).select("uri", *M.METADATA_COLUMNS)
    return M.select_metadata(docs, collections=False, permissions=False, properties=False, metadata=False)


@query(
    "merge_collections",
    "select doc_id, array_to_string(list_sort(list_distinct([lang, source, 'en', 'imported'])), ',') as collections from documents",
)
def q_merge_collections(spark, sf):
    given = F.array(F.lit("en"), F.lit("imported"), F.lit(""))
    merged = M.merge_collections(F.array("lang", "source"), given)
    return table(spark, sf, "documents").select("doc_id", F.array_join(merged, ",").alias("collections"))


def _flat_permissions(c):
    return F.array_join(F.transform(c, lambda p: F.concat_ws(":", p["role"], p["capability"])), ",")


@query("parse_permissions", "select doc_id, lang||':read,'||source||':update' as permissions from documents")
def q_parse_permissions(spark, sf):
    text = F.concat("lang", F.lit(",read, "), "source", F.lit(",UPDATE"))
    return table(spark, sf, "documents").select("doc_id", _flat_permissions(M.parse_permissions(text)).alias("permissions"))


@query(
    "merge_permissions",
    """select doc_id, array_to_string(list_sort(list_distinct(list_filter([lang||':read', source||':node-update', 'en:read', 'admin:update'],
 lambda p: lang <> 'en' or p not like '%:node-update'))), ',') as permissions from documents""",
)
def q_merge_permissions(spark, sf):
    stored = M.parse_permissions(F.concat("lang", F.lit(",read,"), "source", F.lit(",node-update")))
    given = M.parse_permissions(F.lit("en,read,admin,update"))
    merged = M.merge_permissions(stored, given, naked=F.col("lang") == "en")
    return table(spark, sf, "documents").select("doc_id", _flat_permissions(merged).alias("permissions"))


@query("default_quality", "select doc_id, quality as kept, 5 as configured from labels")
def q_default_quality(spark, sf):
    q = F.col("quality")
    return table(spark, sf, "labels").select(
        "doc_id", M.default_quality(q, 0).alias("kept"), M.default_quality(q, 5).alias("configured")
    )


@query("metadata_record", "select doc_id, 'TEXT' as format, lang||','||source as collections, lang as role, (doc_id % 5)::int as quality from documents")
def q_metadata_record(spark, sf):
    docs = text_docs(spark, sf).select(
        F.col("line").alias("doc_id"), "content_type", "collections",
        M.parse_permissions(F.concat(F.col("collections")[0], F.lit(",read"))).alias("permissions"),
        (F.col("line") % 5).cast("int").alias("quality"), "meta", "properties", "naked",
    )
    record = docs.select("doc_id", M.metadata_to_json().alias("entry"))
    back = record.select("doc_id", M.metadata_from_json(F.col("entry")).alias("m"))
    return back.select(
        "doc_id", "m.format", F.array_join("m.collections", ",").alias("collections"),
        F.col("m.permissions")[0]["role"].alias("role"), "m.quality",
    )


@query(
    "triple_to_xml",
    """select c_custkey, '<sem:triple><sem:subject>urn:c:'||c_custkey||'</sem:subject><sem:predicate>urn:p</sem:predicate><sem:object'||
 case when c_nationkey < 8 then ' xml:lang=''en''' when c_nationkey < 16 then ' datatype=''http://www.w3.org/2001/XMLSchema#string''' else '' end
 ||'>&lt;'||c_name||'&gt; &amp; '||c_mktsegment||'</sem:object></sem:triple>' as xml from customer""",
)
def q_triple_to_xml(spark, sf):
    n = F.col("c_nationkey")
    xml = R.triple_to_xml(
        F.format_string("urn:c:%d", "c_custkey"), F.lit("urn:p"), F.format_string("<%s> & %s", "c_name", "c_mktsegment"),
        F.when(n < 16, "literal").otherwise("iri"), F.lit(None).cast("string"), F.when(n < 8, "en"),
    )
    return table(spark, sf, "customer").select("c_custkey", xml.alias("xml"))


@query("blank_node_iri", "select c_nationkey::varchar as label, count(*) as statements, 1::bigint as iris from customer group by c_nationkey")
def q_blank_node_iri(spark, sf):
    """A label names one node all through a file."""
    lines = table(spark, sf, "customer").select(
        F.lit("customer").alias("src_id"), F.lit("").alias("sub_id"), F.col("c_custkey").alias("line"),
        F.format_string('_:n%d <urn:has> "%s" .', "c_nationkey", "c_name").alias("value"), "c_nationkey",
    )
    triples = parse_statements(lines, salt="run-1").join(lines.select("line", "c_nationkey"), "line")
    counted = triples.groupBy("c_nationkey", "s").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(F.col("c_nationkey").cast("string").alias("label")).agg(
        F.sum("n").alias("statements"), F.count("s").alias("iris")
    )


@query("xml_text", "select '/customer/'||c_custkey||'.xml' as uri, c_custkey||c_name||c_nationkey||c_acctbal||c_mktsegment as words from customer")
def q_xml_text(spark, sf):
    return customer_xml(spark, sf).select("uri", X.xml_text(F.col("text")).alias("words"))


@query("cast_value", "select c_custkey as as_long, c_nationkey as as_int, c_acctbal as as_double, c_acctbal > 0 as as_boolean, null::int as no_int from customer")
def q_cast_value(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        X.cast_value(F.col("c_custkey").cast("string"), "Long").alias("as_long"),
        X.cast_value(F.col("c_nationkey").cast("string"), "VInt").alias("as_int"),
        X.cast_value(F.col("c_acctbal").cast("string"), "Double").alias("as_double"),
        X.cast_value((F.col("c_acctbal") > 0).cast("string"), "Boolean").alias("as_boolean"),
        X.cast_value(F.col("c_name"), "Int", strict=False).alias("no_int"),
    )


@query("parse_statement_rejects", "select c_custkey, 'invalid statement: <urn:'||c_custkey||'> '||c_name as skip_reason from customer")
def q_parse_statement_rejects(spark, sf):
    """Malformed lines are reported and do not stop a load."""
    lines = customer_statements(spark, sf).select(F.lit("f").alias("src_id"), F.lit("").alias("sub_id"), F.col("c_custkey").alias("line"), "value")
    broken = table(spark, sf, "customer").select(
        F.lit("f").alias("src_id"), F.lit("").alias("sub_id"), F.col("c_custkey").alias("line"),
        F.format_string("<urn:%d> %s", "c_custkey", "c_name").alias("value"),
    )
    bad = parse_statements(lines.unionByName(broken)).where(F.col("skip_reason").isNotNull())
    return bad.select(F.col("line").alias("c_custkey"), "skip_reason")
