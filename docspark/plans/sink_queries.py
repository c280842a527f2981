"""Sinks and stores: what was written is read back and compared with its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions.uri import filename_of
from docspark.operators.mutate import add_collection_to, apply_node_ops, apply_property_ops
from docspark.plans import jobs
from docspark.plans.catalog import query
from docspark.plans.derive import (
    CUSTOMER_TRIPLES,
    TEXT_DOCS,
    customer_statements,
    customer_xml,
    page_docs,
    stamped_orders,
    table,
    tagged_customers,
    text_dir,
    text_docs,
)
from docspark.plans.source_queries import _LABELLED, _labelled, _text_rows, _with_metadata
from docspark.runtime import work_path
from docspark.schema import to_docs
from docspark.sinks.export import export_archive, export_files, export_zip
from docspark.sinks.records import foreach_kv, write_rejects, write_sequencefile
from docspark.sinks.store import last_by_uri, prepare_target, scan_docs, upsert_docs, write_store
from docspark.sources.archive import read_archive
from docspark.sources.files import read_contents
from docspark.sources.rdf import read_nquads
from docspark.sources.seqfile import read_sequencefile
from docspark.sources.zipped import read_zip_docs

_ORDER_URI = "'/orders/'||o_orderkey||'.json' as uri"


def _live_orders(spark, sf):
    return to_docs(stamped_orders(spark, sf).drop("created_ts", "deleted_ts"))


def _changed_orders(spark, sf):
    """Open orders again with a new text, twice over, and as many new orders as there are customers."""
    orders = _live_orders(spark, sf)
    again = orders.where(F.col("text").contains('"o_orderstatus":"O"'))
    first = again.withColumn("text", F.lit("first change")).withColumn("src_id", F.lit("changes-1"))
    second = again.withColumn("text", F.lit("second change")).withColumn("src_id", F.lit("changes-2"))
    new = to_docs(
        table(spark, sf, "customer"), uri=F.format_string("/orders/new-%d.json", "c_custkey"),
        content_type=F.lit("JSON"), text="c_name", src_id=F.lit("changes-1"), line="c_custkey",
    )
    return second.unionByName(first).unionByName(new)


@query(
    "upsert_docs",
    f"""select {_ORDER_URI}, case when o_orderstatus = 'O' then 'second change' else
 '{{"o_orderkey":'||o_orderkey||',"o_orderstatus":"'||o_orderstatus||'","o_orderpriority":"'||o_orderpriority||'"}}' end as text from orders
 union all select '/orders/new-'||c_custkey||'.json', c_name from customer""",
)
def q_upsert_docs(spark, sf):
    path = work_path(spark, "upsert")
    write_store(_live_orders(spark, sf), path, buckets=8)
    upsert_docs(_changed_orders(spark, sf), path)
    return scan_docs(spark, path).select("uri", "text")


@query("last_by_uri", f"select {_ORDER_URI}, 'second change' as text from orders where o_orderstatus = 'O' union all select '/orders/new-'||c_custkey||'.json', c_name from customer")
def q_last_by_uri(spark, sf):
    """Copies of one URI in one load: the last by source and line stays."""
    return last_by_uri(_changed_orders(spark, sf)).select("uri", "text")


@query("prepare_target", f"select uri, 'refused' as second_load from {TEXT_DOCS}")
def q_prepare_target(spark, sf):
    """A second load is refused, a clean one replaces the first."""
    path = work_path(spark, "target")
    write_store(page_docs(spark, sf), path, buckets=4)
    try:
        prepare_target(spark, path, "fail")
        outcome = "accepted"
    except FileExistsError:
        outcome = "refused"
    write_store(text_docs(spark, sf), path, buckets=4, mode="clean")
    return scan_docs(spark, path).select("uri", F.lit(outcome).alias("second_load"))


@query(
    "copy_docs",
    f"select '/copy'||uri as uri, md5(text) as text_md5, 'copied,'||lang||','||source as collections, 0 as quality from {TEXT_DOCS} where lang = 'en'",
)
def q_copy_docs(spark, sf):
    source, target = work_path(spark, "copy-from"), work_path(spark, "copy-to")
    write_store(_labelled(spark, sf), source, buckets=8)
    jobs.copy_docs(
        spark, source, target, {"prefix": "/copy"}, collections=["copied"], in_collections=["en"], copy_quality=False
    )
    docs = scan_docs(spark, target)
    return docs.select("uri", F.md5("text").alias("text_md5"), F.array_join("collections", ",").alias("collections"), "quality")


@query("export_files", f"select uri, strlen(text)::bigint as bytes_n, null::varchar as error from {TEXT_DOCS}")
def q_export_files(spark, sf):
    return export_files(text_docs(spark, sf), work_path(spark, "export")).select("uri", "bytes_n", "error")


@query("export_zip", f"select uri, md5(text) as text_md5 from {TEXT_DOCS} union all select '/pages/'||page_id||'.html', md5(html) from pages")
def q_export_zip(spark, sf):
    """A small roll-over size makes each task write several zips."""
    path = work_path(spark, "export-zip")
    export_zip(text_docs(spark, sf).unionByName(page_docs(spark, sf)), path, roll_bytes=1 << 20)
    return _text_rows(read_zip_docs(spark, path))


@query("export_archive", _LABELLED)
def q_export_archive(spark, sf):
    path = work_path(spark, "export-archive")
    export_archive(_labelled(spark, sf), path, roll_bytes=1 << 20)
    return _with_metadata(read_archive(spark, path))


@query("export_archive_naked", "select doc_id, quality, true as naked from labels")
def q_export_archive_naked(spark, sf):
    """Metadata without a document survives the round trip."""
    path = work_path(spark, "export-naked")
    naked = to_docs(
        table(spark, sf, "labels"), uri=F.format_string("/labels/%d", "doc_id"), content_type=F.lit("TEXT"), naked=F.lit(True)
    )
    export_archive(naked, path)
    back = read_archive(spark, path)
    return back.select(F.regexp_extract("uri", r"(\d+)$", 1).cast("bigint").alias("doc_id"), "quality", "naked")


@query("export_large_entries", f"select uri, md5(text) as text_md5 from {TEXT_DOCS}")
def q_export_large_entries(spark, sf):
    """Entries above a (lowered) limit of a row stream by reference: zip, archive, store, files."""
    zips, archive, store, out = (work_path(spark, f"large-{n}") for n in ("zips", "archive", "store", "files"))
    export_zip(text_docs(spark, sf), zips)
    export_archive(read_zip_docs(spark, zips, max_bytes=1000), archive)
    write_store(read_archive(spark, archive, max_bytes=1000).where("skip_reason is null"), store, buckets=8)
    export_files(scan_docs(spark, store), out)
    files = read_contents(spark, out)
    uri = F.regexp_extract("path", "(/[^/]*/[^/]*\\.txt)$", 1)
    return files.select(uri.alias("uri"), F.md5("content").alias("text_md5"))


@query("extract_docs", f"select uri, strlen(text)::bigint as bytes_n from {TEXT_DOCS} where source = 'src1'")
def q_extract_docs(spark, sf):
    store, out = work_path(spark, "extract-from"), work_path(spark, "extract")
    write_store(text_docs(spark, sf), store, buckets=8)
    return jobs.extract_docs(spark, store, out, directories=["/src1"]).select("uri", "bytes_n")


@query(
    "import_docs",
    """select count(*) as estimated_input, count(*) as input_records, count(*) filter (event_type <> 'error') as output_records,
 count(*) filter (event_type <> 'error') as committed_records, 0::bigint as failed_records from events""",
)
def q_import_docs(spark, sf):
    docs = to_docs(
        table(spark, sf, "events"), uri=F.format_string("/event/%d.json", "event_id"), content_type=F.lit("JSON"),
        text="props", skip_reason=F.when(F.col("event_type") == "error", "leading space"),
    )
    return jobs.import_docs(docs, work_path(spark, "import-to"), work_path(spark, "rejects"), ["events"], "reader,read")


@query(
    "apply_node_ops",
    """select '/tagged/'||c_custkey||'.xml' as uri, case when c_nationkey < 12 then 'renamed' else c_name end as name,
 case when c_nationkey < 12 then 'before,renamed,after,'||c_mktsegment||' in nation '||c_nationkey||',last' else c_name||','||c_mktsegment||' in nation '||c_nationkey end as children from customer""",
)
def q_apply_node_ops(spark, sf):
    """All four operations, in order, on some of the documents."""
    todo = [
        (0, "/customer/name", "insert-before", "<b>before</b>"),
        (1, "/customer/name", "insert-after", "<b>after</b>"),
        (2, "//customer", "insert-child", "<b>last</b>"),
        (3, "/customer/name[1]", "replace", "<name>renamed</name>"),
    ]
    steps = F.array(*[F.struct(F.lit(q).alias("seq"), F.lit(p).alias("path"), F.lit(o).alias("op"), F.lit(x).alias("xml")) for q, p, o, x in todo])
    ops = table(spark, sf, "customer").where("c_nationkey < 12").select(
        F.format_string("/tagged/%d.xml", "c_custkey").alias("uri"), F.inline(steps)
    )
    docs = apply_node_ops(tagged_customers(spark, sf), ops)
    return docs.select(
        "uri", F.xpath_string("text", F.lit("/customer/name")).alias("name"),
        F.array_join(F.xpath("text", F.lit("/customer/*/text()")), ",").alias("children"),
    )


def _property_ops(spark, sf):
    labels = table(spark, sf, "labels")
    uri = F.format_string("/doc/%d", "doc_id").alias("uri")
    quality = labels.select(uri, F.lit("quality").alias("name"), F.col("quality").cast("string").alias("value"), F.lit(1).alias("seq"))
    toxic = labels.select(uri, F.lit("toxic").alias("name"), F.col("toxic").cast("string").alias("value"), F.lit(0).alias("seq"))
    return quality.unionByName(toxic)


def _property_docs(spark, sf):
    return to_docs(
        table(spark, sf, "documents").where("lang = 'en'"), uri=F.format_string("/doc/%d", "doc_id"), content_type=F.lit("TEXT"), text="text",
        properties=F.array(F.struct(F.lit("toxic").alias("name"), F.lit("unknown").alias("value"))),
    )


def _flat_properties(docs):
    return docs.select("uri", F.array_join(F.transform("properties", lambda p: F.concat_ws("=", p["name"], p["value"])), ",").alias("properties"))


@query(
    "apply_property_ops",
    """select '/doc/'||doc_id as uri, case when quality is null then 'toxic=unknown' else 'quality='||quality||',toxic='||toxic end as properties
 from documents left join labels using (doc_id) where lang = 'en'""",
)
def q_apply_property_ops(spark, sf):
    return _flat_properties(apply_property_ops(_property_docs(spark, sf), _property_ops(spark, sf)))


@query(
    "apply_property_ops_add",
    """select '/doc/'||doc_id as uri, case when lang = 'en' then 'toxic=unknown' else '' end||case when lang = 'en' and quality is not null then ',' else '' end
 ||case when quality is not null then 'toxic='||toxic||',quality='||quality else '' end as properties
 from documents left join labels using (doc_id) where lang = 'en' or quality is not null""",
)
def q_apply_property_ops_add(spark, sf):
    """Added properties pile up; documents that do not exist are made."""
    return _flat_properties(apply_property_ops(_property_docs(spark, sf), _property_ops(spark, sf), add=True, always_create=True))


@query("foreach_kv", "select c_name as key, c_mktsegment as value from customer")
def q_foreach_kv(spark, sf):
    """The user statement writes one file per pair, named after the key."""
    from docspark.sources.io import resolve

    path = work_path(spark, "kv")

    def setup():
        fs, root = resolve(path)
        fs.create_dir(root, recursive=True)

        def statement(key, value):
            with fs.open_output_stream(f"{root}/{key}", compression=None) as f:
                f.write(value.encode())

        return statement

    pairs = table(spark, sf, "customer").select(F.col("c_name").alias("key"), F.col("c_mktsegment").alias("value"))
    foreach_kv(pairs, None, setup)
    files = read_contents(spark, path)
    return files.select(filename_of(F.col("path")).alias("key"), F.col("content").cast("string").alias("value"))


@query(
    "add_collections",
    """select '/customer/'||c_custkey||'.xml' as uri, case when exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
 then c_mktsegment||',pending' else c_mktsegment end as collections from customer""",
)
def q_add_collections(spark, sf):
    keyed = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.format_string("/customer/%d.xml", "o_custkey").alias("uri"), F.lit("pending").alias("collection")
    )
    docs = add_collection_to(customer_xml(spark, sf), keyed)
    return docs.select("uri", F.array_join("collections", ",").alias("collections"))


@query("write_sequencefile", "select '/customer/'||c_custkey||'.xml' as uri, hex(encode(c_name)) as bytes_hex from customer")
def q_write_sequencefile(spark, sf):
    path = work_path(spark, "seq-bytes")
    docs = to_docs(table(spark, sf, "customer"), uri=F.format_string("/customer/%d.xml", "c_custkey"), bytes=F.encode("c_name", "UTF-8"))
    write_sequencefile(docs, path, "BYTES")
    return read_sequencefile(spark, path, "BYTES").select("uri", F.hex("bytes").alias("bytes_hex"))


@query("write_rejects", "select event_id as line, 'leading space' as skip_reason from events where event_type = 'error'")
def q_write_rejects(spark, sf):
    path = work_path(spark, "rejects")
    docs = to_docs(
        table(spark, sf, "events"), uri=F.col("event_id").cast("string"), line="event_id",
        skip_reason=F.when(F.col("event_type") == "error", "leading space"),
    )
    write_rejects(docs, path)
    return spark.read.parquet(path).select("line", "skip_reason")


@query(
    "import_triples",
    f"""select graph as collection, count(*) as docs, case when n_regionkey = 1 then n_name else 'reader' end as role from (
 select case when graph = '' then 'urn:docspark:default-graph' else graph end as graph, part from (
 select graph, (row_number() over (partition by graph order by s, p, o) - 1) // 100 as part from {CUSTOMER_TRIPLES}) group by graph, part)
 left join nation on graph = 'urn:nation:'||n_nationkey group by graph, role""",
)
def q_import_triples(spark, sf):
    """Graphs of one region are stored already, with permissions of their own."""
    path = text_dir(customer_statements(spark, sf), F.col("value"), "triples")
    stored = table(spark, sf, "nation").where("n_regionkey = 1").select(
        F.format_string("urn:nation:%d", "n_nationkey").alias("graph"),
        F.array(F.struct(F.col("n_name").alias("role"), F.lit("read").alias("capability"))).alias("permissions"),
    )
    store = work_path(spark, "triple-store")
    jobs.import_triples(read_nquads(spark, path), store, stored_graphs=stored, permissions="reader,read")
    docs = scan_docs(spark, store, directories=["/triplestore"])
    role = F.element_at(F.transform("permissions", lambda p: p["role"]), 1)
    return docs.groupBy(F.get("collections", 0).alias("collection"), role.alias("role")).agg(F.count(F.lit(1)).alias("docs"))
