"""Redaction changes what a rule selects, and not a byte beside it."""

import json

import pytest

from docspark.functions.spans import json_edits, xml_edits
from docspark.operators.redact import redact
from docspark.schema import to_docs


def run(spark, text, rules, kind="XML"):
    docs = to_docs(spark.createDataFrame([("/1", text, kind)], "uri string, text string, content_type string"))
    return redact(docs, rules).first()["text"]


JSON = '{ "a":1.10,\t"b" : [12345678901234567890.123456789, 1e400, -0, "\\u00e9\\/"],\n "a":"x\\ny", "c": {"a": null, "d":true} , "":[ ]}'


def test_json_beside_the_rule_stays(spark):
    masked = run(spark, JSON, [{"path": "$.a", "kind": "mask"}], "JSON")
    assert masked == JSON.replace("1.10", '"#.##"', 1).replace('"x\\ny"', '"#\\n#"')
    assert run(spark, JSON, [{"path": "$.c", "kind": "mask"}], "JSON") == JSON.replace("true", '"####"')
    assert run(spark, JSON, [{"path": "$.none", "kind": "mask"}], "JSON") == JSON
    assert run(spark, JSON, [{"path": "$.b[*]", "kind": "regex", "pattern": "[0-9]", "replacement": '"'}], "JSON").count('\\"') == 20 + 9 + 4 + 1


@pytest.mark.parametrize(
    "path, want",
    [
        ("$.a", '{"b" : [1, 2 ,3] , "c": {} }'),
        ("$.b", '{ "a":1.10,"a":2, "c": {} }'),
        ("$.c", '{ "a":1.10,\t"b" : [1, 2 ,3] ,"a":2 }'),
        ("$.b[*]", '{ "a":1.10,\t"b" : [] ,"a":2, "c": {} }'),
    ],
)
def test_json_members_go_with_their_comma(spark, path, want):
    text = '{ "a":1.10,\t"b" : [1, 2 ,3] ,"a":2, "c": {} }'
    got = run(spark, text, [{"path": path, "kind": "conceal"}], "JSON")
    assert json.loads(got) == json.loads(want)
    assert got.replace(" ", "").replace("\t", "") == want.replace(" ", "").replace("\t", "")


def test_rules_act_in_order(spark):
    rules = [
        {"path": "$.b", "kind": "conceal"},
        {"path": "$.a", "kind": "regex", "pattern": "^x", "replacement": "secret "},
        {"path": "$.a", "kind": "mask"},
        {"path": "$.b.c", "kind": "mask"},
    ]
    assert run(spark, '{"a":"xy","b":{"c":1}}', rules, "JSON") == '{"a":"###### #"}'
    assert run(spark, "<a><n>1</n><n>2</n></a>", [{"path": "/a/n[1]", "kind": "conceal"}, {"path": "/a/n[1]", "kind": "mask"}]) == "<a><n>#</n></a>"


XML = """<?xml version='1.0' standalone="no"?>
<!DOCTYPE a [<!ENTITY e 'val<![CDATA[ue'> <!-- ]> --> <!ENTITY f "&#38;amp; x">]>
<a  xmlns:p='u:1' k = 'v"w' ><!-- keep --><b>t&amp;&f;<![CDATA[<c>]]>&#x41;</b
><p:n x='1' y="it's">s1&f;<i j='2'>deep</i><!-- secret --><?pi secret?> <![CDATA[s2]]></p:n><n/>
tail</a  ><!-- end -->
""".replace("val<![CDATA[ue", "value")


def test_xml_beside_the_rule_stays(spark):
    masked = run(spark, XML, [{"path": "/a/n", "kind": "mask"}])
    assert masked == XML.replace("x='1'", 'x="1"').replace("s1&f;", "##&amp; #").replace("deep", "####").replace("<!-- secret --><?pi secret?>", "").replace("<![CDATA[s2]]>", "##")
    assert run(spark, XML, [{"path": "/a/p:n/i/@j", "kind": "mask"}]) == XML.replace("j='2'", "j='#'")
    assert run(spark, XML, [{"path": "/a/@k", "kind": "regex", "pattern": "v", "replacement": "'<&\n"}]) == XML.replace("'v\"w'", "'&apos;&lt;&amp;&#10;\"w'")
    assert run(spark, XML, [{"path": "//i", "kind": "conceal"}, {"path": "//@x", "kind": "conceal"}][:1]) == XML.replace("<i j='2'>deep</i>", "")
    assert run(spark, XML, [{"path": "/a/none", "kind": "mask"}]) == XML
    assert run(spark, XML, [{"path": "/a/p:n/@x", "kind": "conceal"}]) == XML.replace(" x='1'", "")


def test_namespaces_of_elements(spark):
    text = '<a xmlns="u:d" xmlns:p="u:1"><n>x</n><p:n>x</p:n><n xmlns="u:1">x</n></a>'
    got = run(spark, text, [{"path": "/a/q:n", "kind": "mask", "namespaces": {"q": "u:1"}}])
    assert got == '<a xmlns="u:d" xmlns:p="u:1"><n>x</n><p:n>#</p:n><n xmlns="u:1">#</n></a>'


@pytest.mark.parametrize("text", ["<a><n></a>", "<a>&none;</a>", "", "<a/><b/>", "<p:a/>", "<!DOCTYPE a [<!ENTITY e '<n>s</n>'>]><a>&e;</a>"])
def test_xml_that_cannot_be_followed_is_an_error(text):
    with pytest.raises(Exception):  # noqa: B017
        xml_edits(text, [(0, "/a/n", False, {})])


@pytest.mark.parametrize("text", ["", "{", '{"a":NaN}', '{"a":Infinity}', "[1,]", '{"a" 1}'])
def test_json_that_does_not_parse_is_an_error(text):
    with pytest.raises(ValueError):
        json_edits(text, [(0, "$.a", False, {})])


def test_deep_and_long_documents():
    text = "<a>" + "<b>" * 5000 + "s" + "</b>" * 5000 + "</a>"
    pieces, parts = xml_edits(text, [(0, "/a", False, {})]).pieces()
    assert "".join(pieces) + "s" and parts == [("s", 0, [0])]
    many = "[" + ",".join('{"k":%d}' % i for i in range(20_000)) + "]"
    pieces, parts = json_edits(many, [(0, "$.k", False, {})]).pieces()
    assert len(parts) == 20_000 and parts[7][0] == "7"
