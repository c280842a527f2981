"""Queries over nested folders, repeated URIs, element paths, namespaces and nested content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import xml_text
from docspark.functions.tree import has_element
from docspark.operators import lexicon as L
from docspark.operators.redact import redact
from docspark.plans.catalog import query
from docspark.plans.derive import as_files, customer_json, customer_xml, packed_files, table, text_dir
from docspark.runtime import by_key, work_path
from docspark.schema import to_docs
from docspark.sinks.store import last_by_uri, scan_docs, upsert_docs, write_store
from docspark.sources import scans
from docspark.sources.delimited import read_csv_docs
from docspark.sources.ndjson import read_ndjson

_EVENT = """'{"id":'||event_id||',"type":"'||event_type||'"}'"""


def _event(name="event_id"):
    return F.format_string('{"id":%d,"type":"%s"}', F.col(name), "event_type")


@query("read_ndjson_nested", f"select '/event/'||event_id as uri, {_EVENT} as text from events")
def q_read_ndjson_nested(spark, sf):
    """Files in folders below folders, named by a regex; others lie beside them."""
    path = work_path(spark, "ndjson-nested")
    lines = table(spark, sf, "events").select(_event().alias("value"), "event_type", (F.col("user_id") % 3).alias("part"))
    lines.write.partitionBy("event_type", "part").text(path)
    table(spark, sf, "region").select("r_name").write.mode("append").option("compression", "gzip").text(f"{path}/other")
    return read_ndjson(spark, path, uri_id="id", prefix="/event/", pattern=r"part-.*\.txt").select("uri", "text")


@query(
    "read_csv_split_nested",
    """select '/c/'||c_custkey as uri, c_name as name, c_mktsegment as segment, c_acctbal::varchar as balance from customer""",
)
def q_read_csv_split_nested(spark, sf):
    """One header in many folders; a field holds a control character."""
    path = work_path(spark, "csv-nested")
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("\u0001")).alias("c_name"), "c_mktsegment", "c_acctbal", F.col("c_nationkey").alias("n")
    )
    rows.write.partitionBy("n").options(header="true").csv(path)
    docs = read_csv_docs(spark, path, uri_id="c_custkey", doc_type="JSON", prefix="/c/", split=True, pattern=r".*\.csv")
    at = lambda n: F.get_json_object("text", f"$.{n}")
    return docs.select("uri", F.rtrim(at("c_name"), F.lit("\u0001")).alias("name"), at("c_mktsegment").alias("segment"), at("c_acctbal").alias("balance"))


@query(
    "upsert_last_in_file",
    f"select '/u/'||user_id as uri, max_by({_EVENT}, event_id) as text from events group by user_id",
)
def q_upsert_last_in_file(spark, sf):
    """Of the lines of a file that name one URI the last stays."""
    events = table(spark, sf, "events").repartition(1).sortWithinPartitions("event_id")
    line = F.format_string('{"user":%d,"body":{"id":%d,"type":"%s"}}', "user_id", "event_id", "event_type")
    docs = last_by_uri(read_ndjson(spark, text_dir(events, line, "ndjson-last"), uri_id="user", prefix="/u/"))
    return docs.select("uri", F.get_json_object("text", "$.body").alias("text"))


def _namespaced(spark, sf):
    """Customers as XML with the same element name in two namespaces, nested content and a CDATA section."""
    c = table(spark, sf, "customer")
    text = F.format_string(
        '<c xmlns:p="urn:one" xmlns:q="urn:two"><p:b>%s</p:b><q:b k="%d">%s<i>%d</i></q:b><d><![CDATA[<%s>]]></d></c>',
        "c_name", "c_nationkey", "c_mktsegment", "c_custkey", "c_mktsegment",
    )
    uri = F.concat(F.lit("/ns/"), F.col("c_custkey").cast("string"))
    return to_docs(c, uri=uri, content_type=F.lit("XML"), text=F.when(F.col("c_nationkey") > 4, text).otherwise(F.replace(text, F.lit("urn:two"), F.lit("urn:six"))))


@query("scan_nodes_elements", "select '/customer/'||c_custkey||'.xml' as uri, '(/customer/c_name)[1]' as path, c_name as value from customer")
def q_scan_nodes_elements(spark, sf):
    """An element path gives mark-up, which parses again."""
    nodes = scans.scan_nodes(customer_xml(spark, sf), "/customer/c_name")
    return nodes.select("uri", "path", xml_text(F.col("node")).alias("value"))


@query("lex_values_element", "select c_mktsegment as term, count(*) as freq from customer group by 1 order by 1")
def q_lex_values_element(spark, sf):
    return L.path_values(customer_xml(spark, sf), "/customer/c_mktsegment")


@query("filter_selector_ns", "select '/ns/'||c_custkey as uri from customer where c_nationkey > 4")
def q_filter_selector_ns(spark, sf):
    """A bound prefix selects elements of its namespace only."""
    return _namespaced(spark, sf).where(has_element(F.col("text"), "/c/x:b", {"x": "urn:two"})).select("uri")


@query(
    "redact_nested",
    """select '/ns/'||c_custkey as uri, c_name as kept, regexp_replace(c_mktsegment||c_custkey, '[A-Z0-9]', '#', 'g') as masked,
 sha256('s<'||c_mktsegment||'>') as hashed from customer""",
)
def q_redact_nested(spark, sf):
    """Whole paths, nested content and CDATA; what comes out parses."""
    rules = [
        {"path": "/c/q:b", "kind": "mask", "namespaces": {"q": "urn:two"}},
        {"path": "/c/q:b", "kind": "mask", "namespaces": {"q": "urn:six"}},
        {"path": "//d", "kind": "hash", "salt": "s"},
    ]
    docs = redact(_namespaced(spark, sf), rules)
    at = lambda path: F.xpath_string("text", F.lit(path))
    return docs.select("uri", at("/c/b[not(@k)]").alias("kept"), at("/c/b[@k]").alias("masked"), at("/c/d").alias("hashed"))


@query(
    "redact_json",
    "select c_custkey as line, regexp_replace(c_name, '[0-9]', 'N', 'g') as name, c_mktsegment as segment, false as has_balance from customer",
)
def q_redact_json(spark, sf):
    rules = [
        {"path": "$.c_name", "kind": "regex", "pattern": "[0-9]", "replacement": "N"},
        {"path": "$.c_acctbal", "kind": "conceal"},
    ]
    docs = redact(customer_json(spark, sf), rules)
    at = lambda n: F.get_json_object("text", f"$.{n}")
    return docs.select("line", at("c_name").alias("name"), at("c_mktsegment").alias("segment"), at("c_acctbal").isNotNull().alias("has_balance"))


_VERBATIM_JSON = ('{ "id" :%1$d,\t"n":1.10, "big":12345678901234567890.123456789,"name": ', '%2$s', ' , "n":1e400, "s":"\\u00e9\\/" }')
_VERBATIM_XML = ("<?xml version='1.0'?>\n<c  id = '%1$d'><!-- kept --><k a='>'>&#65;&amp;<![CDATA[%3$s]]></k ><name>", "%2$s", "<!--%2$s--></name><name/></c >")


def _verbatim_sql(parts, kind, value):
    head, _, tail = parts
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    text = " || ".join([quote(head), value, quote(tail)])
    for mark, column in (("%1$d", "c_custkey::varchar"), ("%3$s", "c_mktsegment")):
        text = f"replace({text}, '{mark}', {column})"
    return f"select '/'||c_custkey as uri, {text} as text from customer where c_nationkey % 2 = {kind}"


@query(
    "redact_verbatim",
    _verbatim_sql(_VERBATIM_JSON, 0, "'\"'||regexp_replace(c_name, '[A-Za-z0-9]', '#', 'g')||'\"'")
    + " union all "
    + _verbatim_sql((*_VERBATIM_XML[:2], "</name><name/></c >"), 1, "regexp_replace(c_name, '[A-Za-z0-9]', '#', 'g')"),
)
def q_redact_verbatim(spark, sf):
    """Numbers, repeated names, quotes, entities and white space beside what a rule selects stay as they stand."""
    c = table(spark, sf, "customer")
    columns = [F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")]
    is_json = F.col("c_nationkey") % 2 == 0
    as_json = F.format_string(f'{_VERBATIM_JSON[0]}"{_VERBATIM_JSON[1]}"{_VERBATIM_JSON[2]}', *columns)
    text = F.when(is_json, as_json).otherwise(F.format_string("".join(_VERBATIM_XML), *columns))
    docs = to_docs(
        c, uri=F.concat(F.lit("/"), F.col("c_custkey").cast("string")), text=text, content_type=F.when(is_json, F.lit("JSON")).otherwise(F.lit("XML"))
    )
    rules = [{"path": "$.name", "kind": "mask"}, {"path": "$.none", "kind": "conceal"}, {"path": "/c/name", "kind": "mask"}]
    return redact(docs, rules).select("uri", "text")


@query(
    "read_csv_stray_quote",
    """select form, '/c/'||c_custkey as uri, c_name as name from customer, (values ('plain'), ('blocks'), ('quoted')) f(form) where c_custkey % 400 <> 7
 union all select form, null, null from customer, (values ('plain'), ('blocks'), ('quoted')) f(form) where c_custkey % 400 = 7""",
)
def q_read_csv_stray_quote(spark, sf):
    """A quote that is opened by mistake costs its row, and no other, however a file is read."""
    c = table(spark, sf, "customer")
    stray = F.format_string('%d,"stray,%s', "c_custkey", "c_mktsegment")
    line = F.when(F.col("c_custkey") % 400 == 7, stray).otherwise(F.format_string("%d,%s,%s", "c_custkey", "c_name", "c_mktsegment"))
    path = as_files(packed_files(c, line, ["c_custkey"], "key,name,segment\n", "\n", ".csv"), "csv-stray")
    forms = []
    for form, split in (("plain", False), ("blocks", True), ("quoted", "quoted")):
        docs = read_csv_docs(spark, path, uri_id="key", doc_type="JSON", prefix="/c/", split=split)
        forms.append(docs.select(F.lit(form).alias("form"), "uri", F.get_json_object("text", "$.name").alias("name")))
    return reduce(DataFrame.unionByName, forms)


@query("read_csv_many_headers", "select '/h/'||c_custkey as uri, c_name as name from customer where c_custkey <= 210")
def q_read_csv_many_headers(spark, sf):
    """A header of its own in every file."""
    return _headers_apart(spark, table(spark, sf, "customer").where("c_custkey <= 210"))


@query("read_csv_header_per_file", "select '/h/'||c_custkey as uri, c_name as name from customer")
def q_read_csv_header_per_file(spark, sf):
    """A header of its own in every file, and a file for every row of the table."""
    return _headers_apart(spark, table(spark, sf, "customer"))


def _headers_apart(spark, c):
    text = F.format_string("key,name_%d\n%d,%s\n", "c_custkey", "c_custkey", "c_name")
    files = to_docs(c, uri=F.format_string("/f%d.csv", "c_custkey"), content_type=F.lit("TEXT"), text=text)
    docs = read_csv_docs(spark, as_files(files, "csv-headers"), uri_id="key", doc_type="JSON", prefix="/h/")
    return docs.select("uri", F.regexp_extract("text", '"name_[0-9]+":"([^"]*)"', 1).alias("name"))


@query(
    "scan_after_large_upsert",
    """select '/o/'||o_orderkey as uri, case when o_orderkey % 5 = 0 then 'third' when o_orderkey % 3 = 0 then 'second' else 'first' end as text from orders
 union all select '/n/'||c_custkey, 'third' from customer""",
)
def q_scan_after_large_upsert(spark, sf):
    """Later loads with more URIs than may be sent to the tasks: only documents that they may replace are shuffled."""
    path = work_path(spark, "store-large")
    orders = table(spark, sf, "orders")
    uri = F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string"))
    version = lambda rows, text: to_docs(rows, uri=uri, content_type=F.lit("TEXT"), text=F.lit(text))
    new = to_docs(table(spark, sf, "customer"), uri=F.concat(F.lit("/n/"), F.col("c_custkey").cast("string")), content_type=F.lit("TEXT"), text=F.lit("third"))
    write_store(version(orders, "first"), path)
    upsert_docs(version(orders.where("o_orderkey % 3 = 0"), "second"), path)
    upsert_docs(version(orders.where("o_orderkey % 5 = 0"), "third").unionByName(new), path)
    return scan_docs(spark, path, broadcast_rows=100).select("uri", "text")


@query(
    "scan_as_of_after_upsert",
    """select '/o/'||o_orderkey as uri, case when o_orderkey % 3 = 0 then 'second' else 'first' end as live,
 'first' as before from orders""",
)
def q_scan_as_of_after_upsert(spark, sf):
    """A store keeps the versions that an upsert replaced."""
    path = work_path(spark, "store-versions")
    orders = table(spark, sf, "orders")
    uri = F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string"))
    version = lambda rows, text, stamp: to_docs(rows, uri=uri, content_type=F.lit("TEXT"), text=F.lit(text), created_ts=F.lit(stamp))
    write_store(version(orders, "first", 10), path)
    upsert_docs(version(orders.where("o_orderkey % 3 = 0"), "second", 20), path)
    now, then = (scan_docs(spark, path, as_of=t).select("uri", F.col("text").alias(name)) for t, name in ((None, "live"), (15, "before")))
    return now.join(by_key(then), "uri")
