"""Inputs on which readers once lost or mixed up data."""

import json
import zipfile

import pytest

from docspark.sources.delimited import read_csv_docs
from docspark.sources.ndjson import read_ndjson
from docspark.sources.rdf import read_nquads, read_rdf_json, read_rdf_zip
from docspark.sources.xml_records import read_xml_records
from docspark.sinks.store import last_by_uri


@pytest.fixture
def nested(tmp_path):
    def put(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))
        return str(tmp_path)

    return put


def uris(df):
    return sorted(r["uri"] for r in df.where("skip_reason is null").select("uri").collect())


def test_folders_below_folders_and_regex_names(spark, nested):
    nested("a/x1.json", '{"id": "1"}\n')
    top = nested("a/b/c/x2.json", '{"id": "2"}\n')
    nested("a/b/other.txt", "{}\n")
    assert uris(read_ndjson(spark, top, uri_id="id", pattern=r"x\d\.json")) == ["1", "2"]
    with pytest.raises(FileNotFoundError):
        read_ndjson(spark, top, pattern=r"y.*")


def test_split_csv_in_folders(spark, nested):
    nested("one.csv", "id,v\n1,a\u0001b\n")
    top = nested("d/e/two.csv", "﻿id,v\r\n2,\u0002x\r\n\r\n2,y\r\n")
    for split in (True, "quoted"):
        docs = read_csv_docs(spark, top, uri_id="id", split=split, doc_type="JSON", pattern=r".*\.csv")
        got = {(r["uri"], r["text"]) for r in last_by_uri(docs).collect()}
        assert {(u, json.loads(t)["v"]) for u, t in got} == {("1", "a\u0001b"), ("2", "y")}
    nested("three.csv", "other,v\n3,c\n")
    with pytest.raises(ValueError):
        read_csv_docs(spark, top, uri_id="id", split=True)


def test_charset_of_block_readers(spark, nested):
    top = nested("l.csv", "id,v\n1,café\n", "latin-1")
    assert "café" in read_csv_docs(spark, top, uri_id="id", split=True, encoding="ISO-8859-1").first()["text"]
    top = nested("n/l.json", '{"id": "é"}\n', "latin-1")
    assert uris(read_ndjson(spark, f"{top}/n", uri_id="id", encoding="ISO-8859-1")) == ["é"]
    with pytest.raises(ValueError):
        read_ndjson(spark, top, encoding="cp037")


def test_many_headers(spark, nested):
    for k in range(205):
        top = nested(f"f{k:03d}.csv", f"id,h{k}\n{k},v{k}\n")
    docs = read_csv_docs(spark, top, uri_id="id", doc_type="JSON")
    assert {r["uri"]: json.loads(r["text"])[f"h{r['uri']}"] for r in docs.collect()} == {str(k): f"v{k}" for k in range(205)}


def test_last_of_a_uri_in_a_file_stays(spark, nested):
    top = nested("a.json", "".join(json.dumps({"id": str(k % 20), "n": k}) + "\n" for k in range(60)))
    docs = last_by_uri(read_ndjson(spark, top, uri_id="id"))
    assert {r["uri"]: json.loads(r["text"])["n"] for r in docs.collect()} == {str(k): 40 + k for k in range(20)}
    rejected = read_ndjson(spark, nested("b/x.json", '{"id": "1"}\nnot json\n') + "/b", uri_id="id").where("skip_reason is not null")
    assert [r["line"] for r in rejected.collect()] == [2]


def test_split_xml_with_records_without_content(spark, nested):
    top = nested("a/b.xml", '<t><r id="q"/><r id="2"><v>2</v></r>\n<r id="3" /><r id="4">x</r></t>')
    docs = read_xml_records(spark, top, element="r", uri_id="@id", split=True)
    assert {r["uri"]: r["text"] for r in docs.collect()} == {
        "q": '<r id="q"/>',
        "2": '<r id="2"><v>2</v></r>',
        "3": '<r id="3" />',
        "4": '<r id="4">x</r>',
    }


def test_statements_in_folders(spark, nested):
    top = nested("x/y/a.nq", '<u:s> <u:p> "v" <u:g> .\n')
    assert read_nquads(spark, top, pattern=r".*\.nq").count() == 1
    top = nested("z/w/a.rj", json.dumps({"u:s": {"u:p": [{"type": "literal", "value": "v"}]}}))
    assert read_rdf_json(spark, f"{top}/z", pattern=r".*\.rj").count() == 1


def test_zip_of_mixed_statements(spark, tmp_path):
    tree = {"u:s": {"u:p": [{"type": "literal", "value": 'a "q"\n\\', "lang": "en"}, {"type": "bnode", "value": "_:b"}, {"type": "uri", "value": "u:o"}]}}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.nt", "<u:s> <u:p> <u:o> .\n<u:s> <u:p> <u:o> <u:g> .\n")
        z.writestr("b.nq", "<u:s> <u:p> <u:o> <u:g> .\n")
        z.writestr("c.rj", json.dumps(tree))
        z.writestr("d.rj", "{broken")
        z.writestr("e.ttl", "x")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    rows = read_rdf_zip(spark, str(tmp_path)).collect()
    good = [r for r in rows if r["skip_reason"] is None]
    assert len(good) == 5
    assert {(r["o"], r["lang"]) for r in good if r["o_type"] == "literal"} == {('a "q"\n\\', "en")}
    bad = {r["sub_id"] or "bad.zip" for r in rows if r["skip_reason"] is not None}
    assert bad == {"a.nt", "d.rj", "e.ttl", "bad.zip"}


def test_literals_with_control_characters(spark, nested):
    top = nested("c.nq", '<u:s> <u:p> "a\x01b" .\n<u:s> <u:p> "\x01x\x01\x01" <u:g> .\n<u:s> <u:p> "y" <u:g\x01> .\n<u:s> <u:p> "z\x02\\n" .\n<u:s> <u:p> z\x01 .\nz\n')
    rows = read_nquads(spark, top).collect()
    assert sorted((r["o"], r["graph"]) for r in rows if r["skip_reason"] is None) == [("\x01x\x01\x01", "u:g"), ("a\x01b", None), ("z\x02\n", None)]
    assert len([r for r in rows if r["skip_reason"]]) == 3


@pytest.mark.parametrize("split", [False, True, "quoted"])
def test_a_stray_quote_costs_its_row(spark, nested, split):
    rows = "".join(f'{k},"q{k}"\n' if k % 3 else f"{k},p{k}\n" for k in range(40)).replace('4,"q4"', '4,"open').replace('17,"q17"', '17,"q"x"')
    top = nested("s.csv", "id,v\n" + rows)
    docs = read_csv_docs(spark, top, uri_id="id", split=split, doc_type="JSON")
    got = {r["uri"]: json.loads(r["text"])["v"] for r in docs.where("skip_reason is null").collect()}
    assert got == {str(k): f"q{k}" if k % 3 else f"p{k}" for k in range(40) if k not in (4, 17)}


def test_lines_behind_a_stray_quote(spark, nested):
    """One task goes on with records that span lines; what is malformed is reported line by line."""
    top = nested("t.csv", 'id,v\n1,"open\n2,a\n3,"b\nc"\n4,d\n5,"x" y\nz"\n6,"e"\n7,"last\n')
    docs = read_csv_docs(spark, top, uri_id="id", doc_type="JSON").collect()
    got = {r["uri"]: json.loads(r["text"])["v"] for r in docs if r["skip_reason"] is None}
    assert got == {"2": "a", "3": "b\nc", "4": "d", "6": "e"}
    assert sorted(r["line"] for r in docs if r["skip_reason"]) == [2, 7, 8, 10]
