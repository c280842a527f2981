"""Lexicons and co-occurrences over documents derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.functions.text import hrefs, words
from docspark.operators import cooccurrence as C
from docspark.operators import lexicon as L
from docspark.plans.catalog import query
from docspark.plans.derive import TEXT_DOCS, customer_json, customer_xml, page_docs, table, tagged_customers, text_docs
from docspark.plans.filter_queries import _HREFS

_WORDS = r"'[\p{L}\p{N}]+'"


@query("lex_uris", "select '/pages/'||page_id||'.html' as term, 1::bigint as freq from pages where '/pages/'||page_id||'.html' >= '/pages/2'")
def q_lex_uris(spark, sf):
    return L.uris(page_docs(spark, sf), start="/pages/2")


@query("lex_uri_match", f"select uri as term, 1::bigint as freq from {TEXT_DOCS} where uri like '/src1/%7.txt'")
def q_lex_uri_match(spark, sf):
    return L.uris(text_docs(spark, sf), pattern="/src1/*7.txt")


_COLLECTIONS = "(select uri, lang as term from {0} union all select uri, source from {0})".format(TEXT_DOCS)


@query("lex_collections", f"select term, count(distinct uri) as freq from {_COLLECTIONS} group by term")
def q_lex_collections(spark, sf):
    return L.collections(text_docs(spark, sf))


@query("lex_collection_match", f"select term, count(distinct uri) as freq from {_COLLECTIONS} where term like 'src_' group by term")
def q_lex_collection_match(spark, sf):
    return L.collections(text_docs(spark, sf), pattern="src?")


def _word_sql(where: str = "true", source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return f"""select term, count(distinct {key}) as freq from (select {key}, unnest(regexp_extract_all(lower({text}), {_WORDS})) as term from {source})
 where {where} group by term"""


@query("lex_words", _word_sql())
def q_lex_words(spark, sf):
    return L.word_lexicon(text_docs(spark, sf))


@query("lex_word_match", _word_sql("term like 'th%e'"))
def q_lex_word_match(spark, sf):
    return L.word_lexicon(text_docs(spark, sf), pattern="th*e")


def _counted(expr: str, where: str = "true", source: str = "customer") -> str:
    return f"select ({expr})::varchar as term, count(*) as freq from {source} where {where} group by 1"


@query("lex_values", _counted("c_acctbal", "c_mktsegment = 'BUILDING'"))
def q_lex_values(spark, sf):
    return L.path_values(customer_xml(spark, sf), "/customer/c_acctbal/text()", restrict=F.array_contains("collections", "BUILDING"))


@query("lex_json_values", _counted("c_mktsegment"))
def q_lex_json_values(spark, sf):
    return L.path_values(customer_json(spark, sf), "$.c_mktsegment")


@query("lex_value_match", _counted("c_name", "c_name like '%#0000____7'"))
def q_lex_value_match(spark, sf):
    return L.path_values(customer_xml(spark, sf), "/customer/c_name/text()", pattern="*#0000????7")


_TWO_NAMES = """select term, count(distinct c_custkey) as freq from (select c_custkey, c_mktsegment as term from customer
 union all select c_custkey, c_nationkey::varchar from customer) where {} group by term"""


@query("lex_element_values", _TWO_NAMES.format("true"))
def q_lex_element_values(spark, sf):
    return L.element_values(customer_xml(spark, sf), ["c_mktsegment", "c_nationkey"])


@query("lex_element_value_match", _TWO_NAMES.format("term like '1%'"))
def q_lex_element_value_match(spark, sf):
    return L.element_values(customer_xml(spark, sf), ["c_mktsegment", "c_nationkey"], pattern="1*")


_NOTE = "c_mktsegment||' in nation '||c_nationkey"


@query("lex_element_words", _word_sql("true", "customer", "c_custkey", _NOTE))
def q_lex_element_words(spark, sf):
    return L.element_words(tagged_customers(spark, sf), ["note"])


@query("lex_element_word_match", _word_sql("term like '%i%'", "customer", "c_custkey", _NOTE))
def q_lex_element_word_match(spark, sf):
    return L.element_words(tagged_customers(spark, sf), ["note"], pattern="*i*")


_ATTRIBUTES = """select term, count(distinct c_custkey) as freq from (select c_custkey, c_mktsegment as term from customer
 union all select c_custkey, c_nationkey::varchar from customer union all select c_custkey, 'en' from customer) where {} group by term"""


@query("lex_attr_values", _ATTRIBUTES.format("true"))
def q_lex_attr_values(spark, sf):
    return L.attribute_values(tagged_customers(spark, sf), ["customer", "note"], ["nation", "segment", "lang"])


@query("lex_attr_value_match", f"select href as term, count(distinct page_id) as freq from {_HREFS} where href like '/a%' group by href")
def q_lex_attr_value_match(spark, sf):
    """Attributes of pages, which are no XML: the terms come from a custom expression."""
    return L.lexicon(page_docs(spark, sf), hrefs(F.col("text")), pattern="/a*")


_SEGMENT_WORDS = ("(select c_custkey, c_mktsegment||' '||c_nationkey as t from customer)", "c_custkey", "t")


@query("lex_attr_words", _word_sql("true", *_SEGMENT_WORDS))
def q_lex_attr_words(spark, sf):
    return L.attribute_words(tagged_customers(spark, sf), ["customer"], ["segment", "nation"])


@query("lex_attr_word_match", _word_sql("term like '_u%'", *_SEGMENT_WORDS))
def q_lex_attr_word_match(spark, sf):
    return L.attribute_words(tagged_customers(spark, sf), ["customer"], ["segment", "nation"], pattern="?u*")


_FIELD = """select term, count(distinct c_custkey) as freq from (select c_custkey, c_name as term from customer
 union all select c_custkey, c_mktsegment from customer) where {} group by term"""


@query("lex_field_values", _FIELD.format("true"))
def q_lex_field_values(spark, sf):
    return L.field_values(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])


@query("lex_field_value_match", _FIELD.format("term like '%r%9'"))
def q_lex_field_value_match(spark, sf):
    return L.field_values(table(spark, sf, "customer"), ["c_name", "c_mktsegment"], pattern="*r*9")


@query("lex_field_words", _word_sql("true", "documents", "doc_id", "lang||' '||text"))
def q_lex_field_words(spark, sf):
    return L.field_words(table(spark, sf, "documents"), ["lang", "text"])


@query("lex_field_word_match", _word_sql("term like 'e%n'", "documents", "doc_id", "lang||' '||text"))
def q_lex_field_word_match(spark, sf):
    return L.field_words(table(spark, sf, "documents"), ["lang", "text"], pattern="e*n")


@query(
    "cooc_values",
    """select c_nationkey::varchar as a, c_mktsegment as b, count(*) as freq from customer group by all""",
)
def q_cooc_values(spark, sf):
    return C.values(customer_xml(spark, sf), "/customer/c_nationkey/text()", "/customer/c_mktsegment/text()")


@query(
    "cooc_words",
    f"""select a, b, count(*) as freq from (select distinct doc_id, source as a, unnest(regexp_extract_all(lower(text), {_WORDS})) as b from documents) group by a, b""",
)
def q_cooc_words(spark, sf):
    """Source and word: one side has one value, so pairs grow with the words of a document only."""
    return C.cooccurrence(text_docs(spark, sf), F.array(F.get("collections", 1)), words(F.col("text")))


@query("cooc_elements", "select c_name as a, c_nationkey::varchar as b, count(*) as freq from customer group by all")
def q_cooc_elements(spark, sf):
    return C.elements(customer_xml(spark, sf), "c_name", "c_nationkey")


@query("cooc_attrs", "select c_nationkey::varchar as a, c_name as b, count(*) as freq from customer group by all")
def q_cooc_attrs(spark, sf):
    """An attribute on one side, the element itself on the other."""
    return C.attributes(tagged_customers(spark, sf), "customer", "nation", "name", None)


@query(
    "cooc_attrs_pages",
    """select title as a, href as b, count(distinct page_id) as freq from (
 select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages) group by all""",
)
def q_cooc_attrs_pages(spark, sf):
    title = F.array(F.regexp_extract("text", "<title>([^<]*)</title>", 1))
    return C.cooccurrence(page_docs(spark, sf), title, hrefs(F.col("text")))


@query("cooc_fields", "select o_orderstatus as a, o_orderpriority as b, count(*) as freq from orders group by all")
def q_cooc_fields(spark, sf):
    return C.fields(table(spark, sf, "orders"), ["o_orderstatus"], ["o_orderpriority"])


@query(
    "cooc_proximity",
    """with t as (select conv_id||'/'||turn as uri, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from conversations),
 w as (select uri, unnest(ws) as word, generate_subscripts(ws, 1) as pos from t)
 select a, b, count(*) as freq from (select distinct x.uri, x.word as a, y.word as b from w x join w y on x.uri = y.uri
 and abs(x.pos - y.pos) <= 2) group by a, b""",
)
def q_cooc_proximity(spark, sf):
    """All words of a turn at most two words apart."""
    uri = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uri")
    found = table(spark, sf, "conversations").select(uri, F.posexplode(words(F.col("text"))).alias("pos", "w"))
    return C.proximity(found.select("uri", "pos", F.col("w").alias("a")), found.select("uri", "pos", F.col("w").alias("b")), 2)


@query("custom_lexicon", "select upper(c_name)||'-'||c_nationkey as term, count(*) as freq from customer group by 1")
def q_custom_lexicon(spark, sf):
    """A user's own term expression."""
    own = F.concat_ws("-", F.upper("c_name"), "c_nationkey")
    return L.lexicon(table(spark, sf, "customer"), F.array(own))


@query("page_terms", _word_sql() + " order by term limit 50 offset 100")
def q_page_terms(spark, sf):
    """A report page of the word lexicon: terms 101 to 150."""
    return L.word_lexicon(text_docs(spark, sf), offset=100, limit=50)


@query(
    "sort_terms",
    f"""select term, freq, row_number() over (order by term) as pos from ({_word_sql()})""",
)
def q_sort_terms(spark, sf):
    """The whole lexicon in ascending order, each term with its position."""
    from docspark.runtime import with_positions

    return with_positions(L.word_lexicon(text_docs(spark, sf), sort=False), ["term"])


_REGION_TERMS = """(select distinct n_regionkey as g, 'c'||(c_custkey % 200) as a from customer join nation on c_nationkey = n_nationkey) x
 join (select distinct n_regionkey as g, strftime(o_orderdate::date, '%Y-%m-%d') as b from orders
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) y using (g)"""


@query(
    "cooc_long_arrays",
    f"select a, count(*) as pairs, sum(freq)::bigint as freq from (select a, b, count(*) as freq from {_REGION_TERMS} group by a, b) group by a",
)
def q_cooc_long_arrays(spark, sf):
    """Each region is one document with two long lists."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    customers = table(spark, sf, "customer").join(F.broadcast(nations), F.col("n_nationkey") == F.col("c_nationkey"))
    name = F.concat(F.lit("c"), (F.col("c_custkey") % 200).cast("string"))
    days = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    a = customers.groupBy("n_regionkey").agg(F.collect_set(name).alias("names"))
    b = days.groupBy("n_regionkey").agg(F.collect_set(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("days"))
    found = C.cooccurrence(a.join(b, "n_regionkey"), F.col("names"), F.col("days"), sort=False)
    return found.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"), F.sum("freq").alias("freq"))
