"""Readers over files written from the given tables; the SQL is the table they were written from."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.plans.catalog import query
from docspark.plans.derive import (
    CUSTOMER,
    CUSTOMER_ROW,
    CUSTOMER_TRIPLES,
    CUSTOMER_XML,
    TEXT_DOCS,
    as_files,
    as_zips,
    csv_dir,
    csv_line,
    customer_statements,
    customer_xml,
    flat_triples,
    gzipped,
    packed_files,
    table,
    text_dir,
    text_docs,
)
from docspark.plans.jobs import import_docs
from docspark.runtime import work_path
from docspark.sinks.export import export_archive, export_files
from docspark.sinks.records import write_sequencefile
from docspark.sinks.store import scan_docs, write_store
from docspark.sources import custom, scans
from docspark.sources.archive import read_archive
from docspark.sources.delimited import read_csv_docs
from docspark.sources.files import decode_text, list_files, read_file_refs, read_files
from docspark.sources.ndjson import read_ndjson, read_ndjson_zip
from docspark.sources.rdf import read_nquads, read_ntriples, read_rdf_json, read_rdf_zip
from docspark.sources.seqfile import read_sequencefile
from docspark.sources.xml_records import read_xml_records
from docspark.sources.zipped import read_gzip_docs, read_zip_docs

_TEXT_ROWS = f"select uri, md5(text) as text_md5 from {TEXT_DOCS}"


def _text_rows(docs):
    return docs.select("uri", F.md5("text").alias("text_md5"))


def _below(path: str) -> list[tuple[str, str]]:
    """URI rule that takes the directory of the files off."""
    return [("^" + path.replace(".", r"\."), "")]


@query("read_files", f"select uri, md5(text) as text_md5, 'TEXT' as content_type from {TEXT_DOCS}")
def q_read_files(spark, sf):
    path = as_files(text_docs(spark, sf), "files")
    docs = read_files(spark, path, replace=_below(path))
    return docs.select("uri", F.md5("text").alias("text_md5"), "content_type")


@query("list_files", "select doc_id||'.txt' as file_name, strlen(text)::bigint as bytes_n from documents")
def q_list_files(spark, sf):
    path = as_files(text_docs(spark, sf), "files")
    return list_files(spark, path, r".*\.txt").select("file_name", "bytes_n")


@query("read_file_refs", f"select uri, strlen(text)::bigint as bytes_n from {TEXT_DOCS}")
def q_read_file_refs(spark, sf):
    path = as_files(text_docs(spark, sf), "files")
    refs = read_file_refs(spark, path, replace=_below(path))
    return export_files(refs, work_path(spark, "refs")).select("uri", "bytes_n")


@query("read_zip_docs", _TEXT_ROWS)
def q_read_zip_docs(spark, sf):
    path = as_zips(text_docs(spark, sf), "zips")
    return _text_rows(read_zip_docs(spark, path))


@query("read_gzip_docs", _TEXT_ROWS)
def q_read_gzip_docs(spark, sf):
    path = as_files(gzipped(text_docs(spark, sf)), "gzips")
    return _text_rows(read_gzip_docs(spark, path, replace=_below(path)))


_TURN_XML = """'<turn><uri><![CDATA['||conv_id||'-'||turn||']]></uri><role><![CDATA['||role||']]></role><text><![CDATA['||trim(text, ' ')||']]></text></turn>'"""


@query("read_csv_docs", f"select '/turns/'||conv_id||'-'||turn||'.xml' as uri, md5({_TURN_XML}) as text_md5 from conversations")
def q_read_csv_docs(spark, sf):
    """Quoted delimiters, doubled quotes and line breaks inside fields."""
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("uri"), "role", F.trim("text").alias("text")
    )
    path = csv_dir(turns, "csv", quoteAll="true")
    return _text_rows(read_csv_docs(spark, path, uri_id="uri", root_name="turn", prefix="/turns/", suffix=".xml"))


@query(
    "read_csv_docs_split_quoted",
    f"select '/turns/'||conv_id||'-'||turn||'.xml' as uri, md5({_TURN_XML}) as text_md5 from conversations",
)
def q_read_csv_docs_split_quoted(spark, sf):
    """The same files cut into blocks."""
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("uri"), "role", F.trim("text").alias("text")
    )
    path = csv_dir(turns, "csv-quoted", quoteAll="true")
    docs = read_csv_docs(spark, path, uri_id="uri", root_name="turn", prefix="/turns/", suffix=".xml", split="quoted")
    return _text_rows(docs)


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(
    "read_csv_docs_split",
    "select '<root>'||"
    + "||".join(f"'<{c}><![CDATA['||{c}||']]></{c}>'" for c in _LINE_COLUMNS)
    + "||'</root>' as text from lineitem",
)
def q_read_csv_docs_split(spark, sf):
    path = csv_dir(table(spark, sf, "lineitem").select(*_LINE_COLUMNS), "csv-split")
    return read_csv_docs(spark, path, generate_uri=True, split=True).select("text")


_CUSTOMER_DOCS = f"select '/customer/'||c_custkey as uri, {CUSTOMER_XML} as text from customer"


@query("read_csv_zip", _CUSTOMER_DOCS)
def q_read_csv_zip(spark, sf):
    rows = table(spark, sf, "customer")
    files = packed_files(rows, csv_line(CUSTOMER), ["c_custkey"], ",".join(CUSTOMER) + "\n", "\n", ".csv")
    path = as_zips(files, "csv-zips")
    docs = read_csv_docs(spark, path, uri_id="c_custkey", root_name="customer", prefix="/customer/", zipped=True)
    return docs.select("uri", "text")


@query("read_csv_gz", _CUSTOMER_DOCS)
def q_read_csv_gz(spark, sf):
    path = csv_dir(table(spark, sf, "customer").select(*CUSTOMER), "csv-gz", compression="gzip")
    docs = read_csv_docs(spark, path, uri_id="c_custkey", root_name="customer", prefix="/customer/")
    return docs.select("uri", "text")


_XML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<m:set xmlns:m="urn:docspark:m">\n'
_XML_RECORDS = f"select '/customer/'||c_custkey as uri, '<m:customer xmlns:m=\"urn:docspark:m\">'||{CUSTOMER_ROW}||'</m:customer>' as text from customer"


def _aggregate_files(spark, sf):
    body = F.replace(F.replace("text", F.lit("<customer>"), F.lit("<m:customer>")), F.lit("</customer>"), F.lit("</m:customer>"))
    return packed_files(customer_xml(spark, sf), body, ["line"], _XML_HEAD, "\n</m:set>\n", ".xml")


_RECORD = dict(element="customer", ns="urn:docspark:m", uri_id="c_custkey", prefix="/customer/")


@query("read_xml_records", _XML_RECORDS)
def q_read_xml_records(spark, sf):
    path = as_files(_aggregate_files(spark, sf), "xml")
    return read_xml_records(spark, path, **_RECORD).select("uri", "text")


@query("read_xml_records_split", f"select '/customer/'||c_custkey as uri, '<m:customer>'||{CUSTOMER_ROW}||'</m:customer>' as text from customer")
def q_read_xml_records_split(spark, sf):
    path = as_files(_aggregate_files(spark, sf), "xml")
    docs = read_xml_records(spark, path, split=True, **_RECORD)
    # the declaration that a record takes from its root
    return docs.select("uri", F.replace("text", F.lit(' xmlns:m="urn:docspark:m"'), F.lit("")).alias("text"))


@query(
    "read_xml_split_hostile",
    """select '/customer/'||c_custkey as uri, '<m:customer xmlns:m="urn:docspark:m" id="'||c_custkey||'"><n><![CDATA[</m:customer> '||c_name
 ||']]></n><!-- </m:customer> --><m:customer id="inner">'||c_mktsegment||'</m:customer></m:customer>' as text from customer""",
)
def q_read_xml_split_hostile(spark, sf):
    """Blocks of files whose comments, CDATA sections and instructions hold what looks like records and their ends."""
    c = table(spark, sf, "customer")
    fake = F.lit('<?skip <m:customer id="instruction"> ?><!-- <m:customer id="comment"> -->')
    body = F.concat(
        fake,
        F.format_string('<m:customer id="%d"><n><![CDATA[</m:customer> %s]]></n><!-- </m:customer> -->', "c_custkey", "c_name"),
        F.format_string('<m:customer id="inner">%s</m:customer></m:customer>', "c_mktsegment"),
    )
    path = as_files(packed_files(c, body, ["c_custkey"], _XML_HEAD, "\n</m:set>\n", ".xml"), "xml-hostile")
    docs = read_xml_records(spark, path, "customer", "urn:docspark:m", "@id", prefix="/customer/", split=True, block_bytes=8192)
    return docs.select("uri", "text")


@query("read_xml_records_zip", _XML_RECORDS)
def q_read_xml_records_zip(spark, sf):
    path = as_zips(_aggregate_files(spark, sf), "xml-zips")
    return read_xml_records(spark, path, zipped=True, **_RECORD).select("uri", "text")


@query("read_xml_records_gz", _XML_RECORDS)
def q_read_xml_records_gz(spark, sf):
    path = as_files(gzipped(_aggregate_files(spark, sf)), "xml-gz")
    return read_xml_records(spark, path, **_RECORD).select("uri", "text")


def _event_line():
    """Errors get a leading space, scrolls an object as id, the others a good line."""
    line = F.format_string('{"id": %d, "type": "%s", "props": %s}', "event_id", "event_type", "props")
    return (
        F.when(F.col("event_type") == "error", F.concat(F.lit(" "), line))
        .when(F.col("event_type") == "purchase", F.format_string('{"type": "purchase", "inner": {"id": %d}}', "event_id"))
        .when(F.col("event_type") == "scroll", F.format_string('{"id": {"n": %d}}', "event_id"))
        .otherwise(line)
    )


_EVENT_LINE = """case event_type when 'purchase' then '{"type": "purchase", "inner": {"id": '||event_id||'}}'
 when 'scroll' then '{"id": {"n": '||event_id||'}}' else '{"id": '||event_id||', "type": "'||event_type||'", "props": '||props||'}' end"""
_EVENT_DOCS = f"""select case when event_type not in ('error', 'scroll') then '/event/'||event_id end as uri,
 case when event_type not in ('error', 'scroll') then {_EVENT_LINE} end as text,
 case event_type when 'error' then 'leading space' when 'scroll' then 'the line names no URI' end as skip_reason from events"""


@query("read_ndjson", _EVENT_DOCS)
def q_read_ndjson(spark, sf):
    path = text_dir(table(spark, sf, "events"), _event_line(), "ndjson")
    return read_ndjson(spark, path, uri_id="id", prefix="/event/").select("uri", "text", "skip_reason")


@query("read_ndjson_gz", _EVENT_DOCS)
def q_read_ndjson_gz(spark, sf):
    path = text_dir(table(spark, sf, "events"), _event_line(), "ndjson-gz", compression="gzip")
    return read_ndjson(spark, path, uri_id="id", prefix="/event/").select("uri", "text", "skip_reason")


@query("read_ndjson_zip", _EVENT_DOCS)
def q_read_ndjson_zip(spark, sf):
    files = packed_files(table(spark, sf, "events"), _event_line(), ["event_id"], "", "\n", ".json")
    path = as_zips(files, "ndjson-zips")
    return read_ndjson_zip(spark, path, uri_id="id", prefix="/event/").select("uri", "text", "skip_reason")


def _labelled(spark, sf):
    """Text documents with quality, permissions, metadata and a property."""
    docs = text_docs(spark, sf)
    return (
        docs.withColumn("quality", (F.col("line") % 7).cast("int"))
        .withColumn("permissions", F.array(F.struct(F.col("collections")[0].alias("role"), F.lit("read").alias("capability"))))
        .withColumn("meta", F.create_map(F.lit("lang"), F.col("collections")[0]))
        .withColumn("properties", F.array(F.struct(F.lit("id").alias("name"), F.col("line").cast("string").alias("value"))))
    )


def _with_metadata(docs):
    return docs.select(
        "uri", F.md5("text").alias("text_md5"), F.array_join("collections", ",").alias("collections"), "quality",
        F.col("permissions")[0]["role"].alias("role"), F.try_element_at("meta", F.lit("lang")).alias("meta_lang"),
        F.col("properties")[0]["value"].alias("property"),
    )


_LABELLED = f"select uri, md5(text) as text_md5, lang||','||source as collections, (doc_id % 7)::int as quality, lang as role, lang as meta_lang, doc_id::varchar as property from {TEXT_DOCS}"


@query("read_archive", _LABELLED)
def q_read_archive(spark, sf):
    path = work_path(spark, "archives")
    export_archive(_labelled(spark, sf), path)
    return _with_metadata(read_archive(spark, path))


@query("read_sequencefile", _TEXT_ROWS)
def q_read_sequencefile(spark, sf):
    path = work_path(spark, "seq")
    write_sequencefile(text_docs(spark, sf), path)
    return _text_rows(read_sequencefile(spark, path))


@query("read_ntriples", f"select s, p, o, datatype, lang, '' as graph from {CUSTOMER_TRIPLES}")
def q_read_ntriples(spark, sf):
    path = text_dir(customer_statements(spark, sf, quads=False), F.col("value"), "nt")
    return flat_triples(read_ntriples(spark, path))


@query("read_nquads", f"select s, p, o, datatype, lang, graph from {CUSTOMER_TRIPLES}")
def q_read_nquads(spark, sf):
    path = text_dir(customer_statements(spark, sf), F.col("value"), "nq")
    return flat_triples(read_nquads(spark, path))


@query(
    "read_rdf_control_chars",
    f"""select 'urn:c:'||c_custkey as s, hex(encode(c_name||chr(1)||'b'||chr(1)||'"'||chr(127)||c_mktsegment)) as o,
 case when c_nationkey % 2 = 0 then 'urn:g' else '' end as graph, null::varchar as skip_reason from customer""",
)
def q_read_rdf_control_chars(spark, sf):
    """Literals that hold control characters come out whole, whatever stands beside them."""
    c = table(spark, sf, "customer")
    graph = F.when(F.col("c_nationkey") % 2 == 0, F.lit(" <urn:g>")).otherwise(F.lit(""))
    line = F.concat(
        F.format_string('<urn:c:%d> <urn:p> "', "c_custkey"), "c_name", F.lit('\u0001b\u0001\\"\u007f'), "c_mktsegment", F.lit('"'), graph, F.lit(" .")
    )
    triples = read_nquads(spark, text_dir(c, line, "rdf-control"))
    return triples.select("s", F.hex("o").alias("o"), F.coalesce("graph", F.lit("")).alias("graph"), "skip_reason")


def _recoded(docs, charset: str):
    """The same documents as files in another charset."""
    none = F.lit(None).cast("string")
    return docs.withColumn("bytes", F.encode("text", charset)).withColumn("text", none).withColumn("content_type", F.lit("BINARY"))


@query("read_ndjson_utf16", _EVENT_DOCS)
def q_read_ndjson_utf16(spark, sf):
    files = packed_files(table(spark, sf, "events"), _event_line(), ["event_id"], "", "\n", ".json")
    path = as_files(_recoded(files, "UTF-16"), "ndjson-utf16")
    return read_ndjson(spark, path, uri_id="id", encoding="UTF-16", prefix="/event/").select("uri", "text", "skip_reason")


@query(
    "import_repeated_batch",
    "select case event_type when 'error' then 'leading space' else 'the line names no URI' end as skip_reason, count(*) as n"
    " from events where event_type in ('error', 'scroll') group by 1"
    " union all select 'loaded', count(*) from events where event_type not in ('error', 'scroll')",
)
def q_import_repeated_batch(spark, sf):
    path = text_dir(table(spark, sf, "events"), _event_line(), "ndjson")
    store, rejects = work_path(spark, "repeated"), work_path(spark, "repeated-rejects")
    for _ in range(2):
        import_docs(read_ndjson(spark, path, uri_id="id", prefix="/event/"), store, rejects, load_id=("events", 1))
    listed = spark.read.parquet(rejects).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n"))
    return listed.unionByName(scan_docs(spark, store).select(F.lit("loaded").alias("skip_reason")).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n")))


@query("read_nquads_utf32", f"select s, p, o, datatype, lang, graph from {CUSTOMER_TRIPLES}")
def q_read_nquads_utf32(spark, sf):
    files = packed_files(customer_statements(spark, sf), F.col("value"), ["c_custkey", "value"], "", "\n", ".nq")
    return flat_triples(read_nquads(spark, as_files(_recoded(files, "UTF-32"), "nq-utf32"), encoding="UTF-32"))


def _rdf_json_files(spark, sf) -> str:
    entry = F.format_string(
        '"urn:customer:%d": {"urn:p:name": [{"value": "%s", "type": "literal"}], '
        '"urn:p:segment": [{"value": "%s", "type": "literal", "lang": "en"}], '
        '"urn:p:balance": [{"value": "%s", "type": "literal", "datatype": "http://www.w3.org/2001/XMLSchema#double"}]}',
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("string"),
    )
    files = packed_files(table(spark, sf, "customer"), entry, ["c_custkey"], "{", "}", ".rj", ",\n")
    return as_files(files, "rdf-json")


@query("read_rdf_json", f"select s, p, o, datatype, lang, '' as graph from {CUSTOMER_TRIPLES}")
def q_read_rdf_json(spark, sf):
    return flat_triples(read_rdf_json(spark, _rdf_json_files(spark, sf)))


@query("read_rdf_json_blocks", f"select s, p, o, datatype, lang, '' as graph from {CUSTOMER_TRIPLES}")
def q_read_rdf_json_blocks(spark, sf):
    # blocks far smaller than a file, so that every file is cut
    return flat_triples(read_rdf_json(spark, _rdf_json_files(spark, sf), block=1 << 14))


@query("read_rdf_zip", f"select s, p, o, datatype, lang, graph from {CUSTOMER_TRIPLES}")
def q_read_rdf_zip(spark, sf):
    files = packed_files(customer_statements(spark, sf), F.col("value"), ["c_custkey", "value"], "", "\n", ".nq")
    return flat_triples(read_rdf_zip(spark, as_zips(files, "rdf-zips")))


@query("read_rdf_gz", f"select s, p, o, datatype, lang, graph from {CUSTOMER_TRIPLES}")
def q_read_rdf_gz(spark, sf):
    path = text_dir(customer_statements(spark, sf), F.col("value"), "nq-gz", compression="gzip")
    return flat_triples(read_nquads(spark, path))


@query("scan_docs", f"select uri, md5(text) as text_md5, lang||','||source as collections from {TEXT_DOCS} where lang = 'en'")
def q_scan_docs(spark, sf):
    path = work_path(spark, "store")
    write_store(text_docs(spark, sf), path)
    docs = scan_docs(spark, path, collections=["en"], copy_permissions=False, copy_properties=False, copy_metadata=False)
    return docs.select("uri", F.md5("text").alias("text_md5"), F.array_join("collections", ",").alias("collections"))


@query(
    "scan_naked_properties",
    "select '/'||doc_id as uri, quality::varchar as property from labels where doc_id not in (select doc_id from documents where lang <> 'en')",
)
def q_scan_naked_properties(spark, sf):
    key = F.concat(F.lit("/"), F.col("doc_id").cast("string")).alias("uri")
    docs = table(spark, sf, "documents").where("lang <> 'en'").select(key)
    props = table(spark, sf, "labels").select(key, F.col("quality").cast("string").alias("property"))
    return scans.scan_naked_properties(docs, props)


@query("scan_nodes", "select '/customer/'||c_custkey||'.xml' as uri, '(/customer/c_name/text())[1]' as path, c_name as node from customer")
def q_scan_nodes(spark, sf):
    return scans.scan_nodes(customer_xml(spark, sf), "/customer/c_name/text()")


@query("scan_values", "select '/customer/'||c_custkey||'.xml' as uri, 0::bigint as pos, c_acctbal as value from customer")
def q_scan_values(spark, sf):
    return scans.scan_values(customer_xml(spark, sf), "/customer/c_acctbal/text()", "double")


@query(
    "scan_key_values",
    """select '/customer/'||c_custkey||'.xml' as uri, c_custkey::varchar as key, c_name as value from customer
 union all select '/customer/'||c_custkey||'.xml', c_nationkey::varchar, c_acctbal::varchar from customer""",
)
def q_scan_key_values(spark, sf):
    return scans.scan_key_values(customer_xml(spark, sf), F.xpath("text", F.lit("/customer/*/text()")))


_QUERY_TEXT = "select o_orderpriority, count(*) as n, min(o_orderkey) as first_key from {orders} where o_totalprice >= :low group by o_orderpriority"


@query("scan_query", "select o_orderpriority, count(*) as n, min(o_orderkey) as first_key from orders where o_totalprice >= 100000 group by o_orderpriority")
def q_scan_query(spark, sf):
    return scans.scan_query(spark, _QUERY_TEXT, {"orders": table(spark, sf, "orders")}, {"low": 100000})


@query("binary_slice", f"select uri, substr(hex(encode(text)), 1, 32) as bytes_hex from {TEXT_DOCS}")
def q_binary_slice(spark, sf):
    docs = text_docs(spark, sf).withColumn("bytes", F.encode("text", "UTF-8"))
    return scans.binary_slice(docs, 16).select("uri", F.hex("bytes").alias("bytes_hex"))


@query("decode_text", _TEXT_ROWS)
def q_decode_text(spark, sf):
    docs = text_docs(spark, sf).withColumn("bytes", F.encode("text", "UTF-16LE"))
    return _text_rows(docs.withColumn("text", decode_text(F.col("bytes"), "UTF-16LE")))


@query("custom_source", f"select uri, md5(text) as text_md5 from {TEXT_DOCS}")
def q_custom_source(spark, sf):
    path = as_files(text_docs(spark, sf), "custom")
    custom.register(spark)
    files = spark.read.format("docspark_files").load(path)
    return files.select(F.replace("uri", F.lit(path), F.lit("")).alias("uri"), F.md5("bytes").alias("text_md5"))


@query("custom_source_stream", f"select uri, md5(text) as text_md5 from {TEXT_DOCS}")
def q_custom_source_stream(spark, sf):
    path, out = as_files(text_docs(spark, sf), "custom"), work_path(spark, "custom-stream")
    custom.register(spark)
    files = spark.readStream.format("docspark_files").option("settleSeconds", "0").load(path)
    write = files.writeStream.format("parquet").option("checkpointLocation", work_path(spark, "custom-check"))
    write.trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.schema(files.schema).parquet(out)
    return rows.select(F.replace("uri", F.lit(path), F.lit("")).alias("uri"), F.md5("bytes").alias("text_md5"))


@query("custom_sink", f"select uri, md5(text) as text_md5 from {TEXT_DOCS}")
def q_custom_sink(spark, sf):
    path = work_path(spark, "custom-sink")
    custom.register(spark)
    rows = text_docs(spark, sf).select("uri", F.encode("text", "UTF-8").alias("bytes"))
    rows.write.format("docspark_files").mode("append").save(path)
    return _text_rows(read_files(spark, path, replace=_below(path)))
