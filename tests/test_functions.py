"""Column functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from docspark.functions import build, metadata, rdf, text, uri


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "raw, encoded",
    [
        ('george b",\nI', "george%20b%22,%0AI"),
        ("/a/b c.txt", "/a/b%20c.txt"),
        ("100%", "100%25"),
        ("a?b#c[d]", "a%3Fb%23c%5Bd%5D"),
        ("Müller/日本", "Müller/日本"),
        ("non break\u0085", "non%C2%A0break%C2%85"),
    ],
)
def test_uri_encode(spark, raw, encoded):
    assert one(spark, uri.uri_encode(F.col("u")), u=raw) == encoded


@pytest.mark.parametrize(
    "raw, reason",
    [
        (":abc", "Expected scheme name at index 0: :abc"),
        ("1a:b", "Illegal character in scheme name at index 0: 1a:b"),
        ("a_b:c", "Illegal character in scheme name at index 1: a_b:c"),
        ("a:", "Expected scheme-specific part at index 2: a:"),
        ("a:b", None),
        ("/x:y", None),
        ("", "empty uri value"),
        (None, "empty uri value"),
    ],
)
def test_uri_build_reasons(spark, raw, reason):
    value, why = uri.uri_build(F.col("u"), prefix="/p/")
    row = spark.createDataFrame([(raw,)], "u string").select(value.alias("v"), why.alias("w")).first()
    assert row.w == reason
    assert (row.v is None) == (reason is not None)


def test_uri_order_replace_encode_prefix(spark):
    value, _ = uri.uri_build(F.col("u"), replace=r"^/tmp,'/a b'", prefix="<", suffix=">")
    assert one(spark, value, u="/tmp/x") == "</a%20b/x>"


@pytest.mark.parametrize("option", ["a", "a,b", "a,'b',c", "a,'"])
def test_uri_replace_rejects_bad_options(option):
    with pytest.raises(ValueError):
        uri.parse_replace_option(option)


@pytest.mark.parametrize(
    "u, path",
    [
        ("http://h/a%20b+c?q=1#f", "/a b+c"),
        ("http://h", ""),
        ("mailto:x%40y", "x@y"),
        ("/plain/path.xml", "/plain/path.xml"),
        ("not a uri", "not a uri"),
        ("bad%zz", "bad%zz"),
    ],
)
def test_path_from_uri(spark, u, path):
    assert one(spark, uri.path_from_uri(F.col("u")), u=u) == path


@pytest.mark.parametrize("directory", ["/out", "/out/"])
@pytest.mark.parametrize("u", ["/a", "a"])
def test_uri_output_dir(spark, directory, u):
    assert one(spark, uri.uri_output_dir(F.col("u"), directory), u=u) == "/out/a"


@pytest.mark.parametrize(
    "header, name",
    [("!f&i%r<s>t b-\ta", "__f_i_r_s_t_b-_a"), ("12last", "_12last"), ("ok.name-1", "ok.name-1"), ("é", "é"), ("-a", "_-a")],
)
def test_valid_name(spark, header, name):
    assert build.valid_name(header) == name
    assert one(spark, build.xml_valid_name(F.col("h")), h=header) == name


@pytest.mark.parametrize(
    "raw, number",
    [
        ("98.0", "98"), ("98.5", "98.5"), ("4,000.00", "4000"), ("-1,234.5", "-1234.5"), (".5", "0.5"),
        ("12345678901234567", "12345678901234567"), ("1E3", "1000"), ("abc", None), ("12abc", None), ("", None), ("1.2.3", None),
    ],
)
def test_number_text(spark, raw, number):
    assert one(spark, build.number_text(F.col("n")), n=raw) == number


def test_number_text_lenient(spark):
    assert one(spark, build.number_text(F.col("n"), lenient=True), n="12abc") == "12"


def test_row_to_json_types(spark):
    rows = [("a\"b", "TRUE", "3.50", "NY"), ("c", "yes", "1", "NY"), ("d", "", "", ""), ("e", "false", "x", "")]
    df = spark.createDataFrame(rows, "name string, soldOut string, price string, state string")
    doc, reason = build.row_to_json({c: F.col(c) for c in df.columns}, "soldOut,boolean,price,Number")
    got = [(r.d, r.r) for r in df.select(doc.alias("d"), reason.alias("r")).collect()]
    assert got[0] == ('{"name":"a\\"b","soldOut":true,"price":3.5,"state":"NY"}', None)
    assert got[1][1] == "Value yes is not type BOOLEAN"
    assert got[2] == ('{"name":"d","state":""}', None)
    assert got[3][1] == "Value x is not type NUMBER"


@pytest.mark.parametrize("option", ["nope,Number", "a,Date", "a"])
def test_data_types_are_checked(option):
    with pytest.raises(ValueError):
        build.parse_data_types(option, ["a"])


def test_row_to_xml_skips_blank_headers(spark):
    doc = build.row_to_xml({"a b": F.lit("1"), "": F.lit("2"), "c": F.lit(None).cast("string")})
    assert one(spark, doc, x=1) == "<root><a_b><![CDATA[1]]></a_b><c><![CDATA[]]></c></root>"


@pytest.mark.parametrize("bad", ["a", "a,read,b", ",read", "a,fly"])
def test_bad_permissions_raise(spark, bad):
    with pytest.raises(Exception, match="permissions need pairs|empty role|unknown capability"):
        one(spark, metadata.parse_permissions(F.col("p")), p=bad)


def test_permissions(spark):
    got = one(spark, metadata.parse_permissions(F.col("p")), p="a,read, b ,NODE-UPDATE")
    assert [(p.role, p.capability) for p in got] == [("a", "read"), ("b", "node-update")]
    assert one(spark, metadata.parse_permissions(F.col("p")), p="") == []


def test_content_type_of(spark):
    cases = {"/a/b.xml": "XML", "/a.b/c": "BINARY", "x.JSON": "JSON", "x.jpg": "BINARY", "x.html": "TEXT", "noext": "BINARY"}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r.u: r.t for r in df.select("u", metadata.content_type_of(F.col("u")).alias("t")).collect()}
    assert got == cases


@pytest.mark.parametrize(
    "term, pattern, hit",
    [("abc", "a*", True), ("abc", "a?c", True), ("abc", "b*", False), ("a.c", "a.c", True), ("abc", "a.c", False),
     ("a\nb", "a*b", True), ("ab", "a?b", False), ("a[1]", "a[*", True)],
)
def test_wildcards(spark, term, pattern, hit):
    assert one(spark, text.matches(F.col("t"), pattern), t=term) is hit


def test_cast_value(spark):
    assert one(spark, text.cast_value(F.col("v"), "VLong"), v="12") == 12
    assert one(spark, text.cast_value(F.col("v"), "Int", strict=False), v="x") is None
    with pytest.raises(ValueError):
        text.cast_value(F.lit("1"), "Date")
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, text.cast_value(F.col("v"), "Int"), v="x")


def test_local_path():
    assert text.local_path("//wp:a[@x:h and child::wp:b = 'http://q:r']/@wp:t") == "//a[@h and child::b = 'http://q:r']/@t"


def test_triple_to_xml_lang_excludes_datatype(spark):
    xml = rdf.triple_to_xml(F.lit("s"), F.lit("p"), F.lit("a<b&c"), F.lit("literal"), F.lit("t"), F.lit("en"))
    assert "<sem:object xml:lang='en'>a&lt;b&amp;c</sem:object>" in one(spark, xml, x=1)


@pytest.mark.parametrize(
    "quad, options, graph",
    [
        ("g", {}, "g"), (None, {}, rdf.DEFAULT_GRAPH), (None, {"output_graph": "o"}, "o"), ("g", {"output_graph": "o"}, "g"),
        ("g", {"override_graph": "v"}, "v"), ("g", {"collections": ["c"]}, "c"),
        ("g", {"collections": ["c"], "output_graph": "o"}, "g"), (None, {"collections": ["c"], "output_graph": "o"}, "o"),
        ("g", {"collections": ["c"], "override_graph": "v"}, "v"),
    ],
)
def test_resolve_graph(spark, quad, options, graph):
    df = spark.createDataFrame([(quad,)], "g string")
    assert df.select(rdf.resolve_graph(F.col("g"), **options).alias("r")).first().r == graph


def test_graph_options_exclude_each_other():
    with pytest.raises(ValueError):
        rdf.resolve_graph(F.lit("g"), override_graph="a", output_graph="b")
