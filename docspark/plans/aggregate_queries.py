"""Aggregations and graph jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions.text import anchors, hrefs
from docspark.operators import aggregates as A
from docspark.operators import graphs as G
from docspark.operators import lexicon as L
from docspark.operators.mutate import apply_node_ops, apply_property_ops
from docspark.operators.report import load_report
from docspark.plans.catalog import query
from docspark.plans.derive import (
    CUSTOMER_TRIPLES,
    TEXT_DOCS,
    as_files,
    customer_xml,
    linked_customers,
    page_docs,
    stamped_orders,
    table,
    text_docs,
)
from docspark.plans.filter_queries import _HREFS, _INTERNAL, _triples
from docspark.schema import to_docs
from docspark.sources.files import read_files


@query("link_count", f"select href as title, count(*) as n from {_HREFS} where {_INTERNAL} group by href")
def q_link_count(spark, sf):
    return A.link_count(page_docs(spark, sf), hrefs(F.col("text")))


@query("link_count_values", f"select href as title, count(*) as n from {_HREFS} where {_INTERNAL} group by href")
def q_link_count_values(spark, sf):
    values = L.lexicon(page_docs(spark, sf), hrefs(F.col("text")), frequency="item", sort=False)
    return A.link_count_values(values)


_ANCHORS = """(select unnest(regexp_extract_all(html, '(<a href="[^"]*">[^<]*</a>)', 1)) as a from pages)"""


@query(
    "link_count_cooccurrence",
    f"""select title, count(*) as n from (select regexp_extract(a, 'href="([^"]*)"', 1) as href, regexp_extract(a, '>([^<]*)<', 1) as title from {_ANCHORS})
 where {_INTERNAL} group by title""",
)
def q_link_count_cooccurrence(spark, sf):
    return A.link_count_pairs(page_docs(spark, sf), anchors(F.col("text")))


@query(
    "link_count_files",
    "select n_name as title, count(*) as n from customer join nation on n_nationkey = c_nationkey group by n_name",
)
def q_link_count_files(spark, sf):
    """Targets and titles are read by two paths and paired; links that lead outside do not count."""
    path = as_files(linked_customers(spark, sf), "linked")
    return A.link_count_files(read_files(spark, path, r".*\.xml"))


def _nation_pages(spark, sf):
    n = table(spark, sf, "nation")
    return to_docs(
        n, uri=F.concat(F.lit("/nation/"), "n_name"), content_type=F.lit("XML"),
        text=F.format_string("<page><title>%s</title></page>", "n_name"),
    )


_REF_COUNTS = """select '/nation/'||n_name as uri, (select count(*) from customer where c_nationkey = n_nationkey)::bigint as n from nation"""


def _title_counts(spark, sf):
    return A.link_count_files(linked_customers(spark, sf))


@query("link_count_to_node", _REF_COUNTS)
def q_link_count_to_node(spark, sf):
    ops = A.link_count_ops(_title_counts(spark, sf), "/nation/", "//page")
    pages = apply_node_ops(_nation_pages(spark, sf), ops)
    return pages.select("uri", F.xpath_long("text", F.lit("/page/ref-count")).alias("n"))


@query("link_count_to_property", _REF_COUNTS)
def q_link_count_to_property(spark, sf):
    ops = A.link_count_properties(_title_counts(spark, sf), "/nation/")
    pages = apply_property_ops(_nation_pages(spark, sf), ops)
    return pages.select("uri", F.coalesce(F.col("properties")[0]["value"].cast("bigint"), F.lit(0)).alias("n"))


@query(
    "group_by_year",
    """select '/customer/'||c_custkey||'.xml' as uri, c_mktsegment as segment,
 (select string_agg(y, ',' order by y) from (select distinct year(o_orderdate)::varchar as y from orders where o_custkey = c_custkey)) as years from customer""",
)
def q_group_by_year(spark, sf):
    revisions = table(spark, sf, "orders").select(
        F.format_string("/customer/%d.xml", "o_custkey").alias("uri"), F.col("o_orderdate").alias("ts")
    )
    docs = A.group_by_year(customer_xml(spark, sf), revisions)
    years = F.array_join(F.filter("collections", lambda c: c.rlike("^[0-9]{4}$")), ",")
    segment = F.filter("collections", lambda c: ~c.rlike("^[0-9]{4}$"))[0]
    return docs.select("uri", segment.alias("segment"), F.nullif(years, F.lit("")).alias("years"))


@query(
    "first_words",
    """select lang, part, count(*) as n, string_agg(word, ' ' order by rn) as words from (
 select lang, word, rn, ((rn - 1) // 1000)::bigint as part from (
 select lang, string_split(text, ' ')[1] as word, row_number() over (partition by lang order by string_split(text, ' ')[1], doc_id) as rn from documents)) group by lang, part""",
)
def q_first_words(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "text")
    return A.first_words(docs, ["lang"], F.col("text"))


@query(
    "concat_archive",
    """select conv_id, part, count(*) as n, '<archives>'||string_agg('<archive>'||chr(10)||'<turn role="'||role||'">'||turn||'</turn></archive>'||chr(10), '' order by turn)||'</archives>' as archive
 from (select *, ((row_number() over (partition by conv_id order by turn) - 1) // 1000)::bigint as part from conversations) group by conv_id, part""",
)
def q_concat_archive(spark, sf):
    text = F.format_string('<?xml version="1.0" encoding="UTF-8"?><turn role="%s">%d</turn>', "role", "turn")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", text.alias("text"))
    return A.concat_archive(turns, ["conv_id"], ["turn"])


@query("regroup_docs", f"select uri, md5(text) as text_md5 from {TEXT_DOCS}")
def q_regroup_docs(spark, sf):
    """Two versions of each document; the later stays, binaries are left out."""
    docs = text_docs(spark, sf)
    older = docs.withColumn("line", F.lit(-1).cast("bigint")).withColumn("text", F.lit("old"))
    binary = docs.withColumn("content_type", F.lit("BINARY")).withColumn("uri", F.concat("uri", F.lit(".bin")))
    out = A.regroup_docs(docs.unionByName(older).unionByName(binary))
    return out.select("uri", F.md5("text").alias("text_md5"))


@query(
    "pack_triples",
    """select event_type as graph, part, count(*) as n, string_agg(event_id::varchar, ',' order by event_id) as ids from (
 select event_type, event_id, ((row_number() over (partition by event_type order by event_id) - 1) // 100)::bigint as part from events) group by event_type, part""",
)
def q_pack_triples(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("graph"), "event_id")
    packed = G.pack(events, F.col("event_id"), ["event_id"], ["graph"])
    return packed.select("graph", "part", "n", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("ids"))


_IN_GRAPHS = f"(select * replace (case when graph = '' then 'urn:docspark:default-graph' else graph end as graph) from {CUSTOMER_TRIPLES})"


def _in_graphs(spark, sf):
    """All statements; those without a graph are in the default one."""
    return _triples(spark, sf).withColumn("graph", G.resolve_graph(F.col("graph")))


@query(
    "pack_triples_docs",
    f"""select graph as collection, count(*) as docs, sum(n)::bigint as triples from (select graph, part, count(*) as n from (
 select graph, (row_number() over (partition by graph order by s, p, o) - 1) // 100 as part from {_IN_GRAPHS}) group by graph, part) group by graph""",
)
def q_pack_triples_docs(spark, sf):
    docs = G.pack_triples(_in_graphs(spark, sf))
    n = F.size(F.regexp_extract_all("text", F.lit("(<sem:triple>)"), F.lit(1))).cast("bigint")
    return docs.groupBy(F.col("collections")[0].alias("collection")).agg(F.count(F.lit(1)).alias("docs"), F.sum(n).alias("triples"))


@query(
    "load_report",
    """select count(*) as estimated_input, count(*) as input_records, count(*) filter (event_type not in ('error')) as output_records,
 count(*) filter (event_type not in ('error', 'purchase')) as committed_records, count(*) filter (event_type = 'purchase') as failed_records from events""",
)
def q_load_report(spark, sf):
    e = table(spark, sf, "events")
    docs = to_docs(
        e, uri=F.col("event_id").cast("string"), skip_reason=F.when(F.col("event_type") == "error", "leading space")
    )
    failed = e.where("event_type = 'purchase'").select(F.col("event_id").cast("string").alias("uri"))
    return load_report(docs, failed=failed)


@query("distinct_graphs", f"select distinct graph from {_IN_GRAPHS}")
def q_distinct_graphs(spark, sf):
    return G.distinct_graphs(_in_graphs(spark, sf))


@query("union_graphs", f"select 'urn:all' as graph, s, p, o from {CUSTOMER_TRIPLES}")
def q_union_graphs(spark, sf):
    return G.union_graphs(_triples(spark, sf), "urn:all").select("graph", "s", "p", "o")


@query(
    "resolve_graph",
    f"""select s, p, case when graph = '' then 'urn:out' else graph end as by_quad, 'urn:over' as by_override,
 'c1' as by_collection, case when graph = '' then 'urn:docspark:default-graph' else graph end as by_default from {CUSTOMER_TRIPLES}""",
)
def q_resolve_graph(spark, sf):
    g = F.col("graph")
    return _triples(spark, sf).select(
        "s", "p", G.resolve_graph(g, output_graph="urn:out").alias("by_quad"),
        G.resolve_graph(g, override_graph="urn:over").alias("by_override"),
        G.resolve_graph(g, collections=["c1", "c2"]).alias("by_collection"),
        G.resolve_graph(g).alias("by_default"),
    )


@query(
    "custom_reduce",
    "select lang, source, max(n_chars) as longest, sum(n_chars)::bigint as chars from documents group by lang, source",
)
def q_custom_reduce(spark, sf):
    from docspark.operators.transform import custom_reduce

    return custom_reduce(
        table(spark, sf, "documents"), ["lang", "source"], F.max("n_chars").alias("longest"), F.sum("n_chars").alias("chars")
    )


@query("custom_reduce_partials", "select l_returnflag, max(l_orderkey) as last_key, sum(l_linenumber)::bigint as lines from lineitem group by l_returnflag")
def q_custom_reduce_partials(spark, sf):
    """A reducer written in pandas: folded per batch, per salted key, then per key."""
    from docspark.operators.transform import custom_reduce_partials

    def fold(pdf):
        return pdf.groupby("l_returnflag", as_index=False).agg({"last_key": "max", "lines": "sum"})

    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_orderkey").alias("last_key"), F.col("l_linenumber").cast("bigint").alias("lines")
    )
    return custom_reduce_partials(rows, ["l_returnflag"], fold, "l_returnflag string, last_key bigint, lines bigint")


@query(
    "load_report_refused",
    """select count(*) as estimated_input, count(*) as input_records, count(*) as output_records,
 count(*) filter (where o_orderstatus <> 'F') as committed_records, count(*) filter (where o_orderstatus = 'F') as failed_records from orders""",
)
def q_load_report_refused(spark, sf):
    from docspark.plans.jobs import import_docs
    from docspark.sinks.records import foreach_reported

    def take(doc) -> None:
        if '"o_orderstatus":"F"' in doc.text:
            raise ValueError("closed orders are not taken")

    return import_docs(stamped_orders(spark, sf), "", sink=lambda good: foreach_reported(good.select("uri", "text"), take))
