"""Element paths, bound prefixes, pages of a lexicon, and redaction by a parser."""

import json
from xml.dom import minidom

import pytest

from docspark.functions.tree import value_path
from docspark.operators import lexicon
from docspark.operators.redact import redact
from docspark.sources import scans


def docs(spark, *texts, kind="XML"):
    return spark.createDataFrame([(f"/{k}", t, kind) for k, t in enumerate(texts)], "uri string, text string, content_type string")


def test_nodes_are_markup(spark):
    df = docs(spark, '<a xmlns:p="u:1"><p:b x="1">t</p:b><b>s<c/></b></a>')
    assert [r["node"] for r in scans.scan_nodes(df, "/a/b").collect()] == ['<p:b x="1" xmlns:p="u:1">t</p:b>', '<b xmlns:p="u:1">s<c/></b>']
    assert [r["node"] for r in scans.scan_nodes(df, "/a/p:b", namespaces={"p": "u:1"}).collect()] == ['<p:b x="1" xmlns:p="u:1">t</p:b>']
    assert scans.scan_nodes(df, "/a/p:b", namespaces={"p": "u:other"}).count() == 0
    assert scans.scan_nodes(df, "//c", selector="//p:b", namespaces={"p": "u:other"}).count() == 0
    assert [r["node"] for r in scans.scan_nodes(df, "//b/@x").collect()] == ["1"]
    with pytest.raises(ValueError):
        scans.scan_nodes(df, "//b[@x]", namespaces={"p": "u:1"})


def test_values_of_elements(spark):
    df = docs(spark, "<a><b>1</b><b>2</b></a>", "<a><b>2</b></a>")
    assert [(r["pos"], r["value"]) for r in scans.scan_values(df, "/a/b", "int").orderBy("uri", "pos").collect()] == [(0, 1), (1, 2), (0, 2)]
    assert [tuple(r) for r in lexicon.path_values(df, "/a/b").collect()] == [("1", 1), ("2", 2)]
    assert [r["value"] for r in scans.scan_values(df, "/a/b", namespaces={"x": "u"}).where("uri = '/0'").collect()] == ["1", "2"]


@pytest.mark.parametrize(
    "path, want",
    [
        ("/a/b", "/a/b/text()"),
        ("//a:b[2]", "//a:b[2]/text()"),
        ("/a/@b", "/a/@b"),
        ("/a/text()", "/a/text()"),
        ("//a|//b/@c", "//a/text()|//b/@c"),
        ("/a/b[. = 'x|y']", "/a/b[. = 'x|y']/text()"),
        ("/a/*", "/a/*/text()"),
    ],
)
def test_value_path(path, want):
    assert value_path(path) == want


def test_pages_take_positions(spark):
    df = spark.createDataFrame([(f"t{k:03d}", 1) for k in range(100)], "term string, freq int")
    page = lexicon.page_terms(df, ["term"], offset=10, limit=5)
    assert [r["term"] for r in page.collect()] == [f"t{k:03d}" for k in range(10, 15)]
    assert "CollectLimit" not in page._jdf.queryExecution().executedPlan().toString()
    down = lexicon.page_terms(df, ["term"], offset=98, descending=True)
    assert [r["term"] for r in down.collect()] == ["t001", "t000"]


def texts(df):
    return [r["text"] for r in df.orderBy("uri").collect()]


def test_redaction_follows_the_whole_path(spark):
    df = docs(spark, "<a><n>s1</n><k><n>keep</n></k></a>")
    assert texts(redact(df, [{"path": "/a/n", "kind": "mask"}])) == ["<a><n>##</n><k><n>keep</n></k></a>"]
    assert texts(redact(df, [{"path": "/a/n", "kind": "conceal"}])) == ["<a><k><n>keep</n></k></a>"]


def test_redaction_of_nested_and_marked_content(spark):
    df = docs(spark, "<a><n>out<n>in</n>tail-secret</n></a>", "<a><n><![CDATA[x<y & z]]></n></a>", "<a><n>a &amp; &lt;b</n></a>", "<a><m/></a>")
    hidden = texts(redact(df, [{"path": "//n", "kind": "conceal"}]))
    assert hidden == ["<a/>", "<a/>", "<a/>", "<a><m/></a>"]
    masked = texts(redact(df, [{"path": "//n", "kind": "mask"}, {"path": "//n", "kind": "mask"}]))
    assert "secret" not in masked[0] and masked[0].count("<n>") == 2
    assert masked[1] == "<a><n>#&lt;# &amp; #</n></a>"
    swapped = texts(redact(df, [{"path": "//n", "kind": "regex", "pattern": ".+", "replacement": "<&>"}]))
    for text in [*hidden, *masked, *swapped]:
        minidom.parseString(text)
    assert swapped[2] == "<a><n>&lt;&amp;&gt;</n></a>"


def test_redaction_of_attributes_and_namespaces(spark):
    df = docs(spark, '<a xmlns:p="u:1" xmlns:q="u:2"><p:n k="s">x</p:n><q:n k="t">y</q:n></a>')
    got = texts(redact(df, [{"path": "//p:n", "kind": "mask", "namespaces": {"p": "u:1"}}, {"path": "//n/@k", "kind": "mask", "char": "*"}]))[0]
    assert ">#</p:n>" in got and ">y</q:n>" in got and got.count('k="*"') == 2


def test_redaction_of_json(spark):
    df = docs(spark, '{"a": {"b": "s", "c": [{"d": 12}, {"d": "t"}]}, "b": "keep"}', kind="JSON")
    got = json.loads(texts(redact(df, [{"path": "$.a.b", "kind": "mask"}, {"path": "$.a.c[*].d", "kind": "mask"}]))[0])
    assert got == {"a": {"b": "#", "c": [{"d": "##"}, {"d": "#"}]}, "b": "keep"}
    assert json.loads(texts(redact(df, [{"path": "$['a']", "kind": "conceal"}]))[0]) == {"b": "keep"}
    assert json.loads(texts(redact(df, [{"path": "$.a", "kind": "mask"}]))[0])["a"]["c"] == [{"d": "##"}, {"d": "#"}]


@pytest.mark.parametrize("path", ["n", "/a/n[@x]", "$", "$..a", "//a/text()", ""])
def test_paths_that_cannot_be_followed(spark, path):
    with pytest.raises(ValueError):
        redact(docs(spark, "<a/>"), [{"path": path, "kind": "mask"}])


def test_no_document_passes_unseen(spark):
    rules = [{"path": "//n", "kind": "mask"}]
    for df in (docs(spark, '{"n": 1}', kind="JSON"), docs(spark, "plain", kind="TEXT"), docs(spark, "<a><n>"), docs(spark, "<n>root</n>").selectExpr("uri", "text", "null as content_type")):
        with pytest.raises(Exception):  # noqa: B017
            redact(df, rules).collect()
    assert texts(redact(docs(spark, "plain", kind="TEXT"), rules, others="keep")) == ["plain"]
