"""Readers on small hand-made files."""

import csv
import gzip
import io
import json
import random
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docspark.sources.archive import MISSING, read_archive
from docspark.sources.delimited import QUOTE_REASON, WIDTH_REASON, read_csv_docs
from docspark.sources.files import read_files
from docspark.sources.ndjson import NO_URI, _find, read_ndjson, read_ndjson_zip
from docspark.sources.rdf import read_nquads, read_ntriples, read_rdf_json
from docspark.sources.xml_records import NO_ID, read_xml_records
from docspark.sources.zipped import list_zip_entries, read_gzip_docs, read_zip_docs, spread_entries


def put(tmp_path, name, data):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def docs(df):
    return {r.uri: r.text for r in df.where("skip_reason is null").collect()}


def reasons(df):
    return sorted(r.skip_reason for r in df.where("skip_reason is not null").collect())


# whole files


def test_files_hidden_empty_pattern_and_nested(spark, tmp_path):
    put(tmp_path, "a/x.xml", "<x/>")
    put(tmp_path, "a/b/y.txt", "héllo")
    put(tmp_path, "_hidden.xml", "<no/>")
    put(tmp_path, ".dot.xml", "<no/>")
    put(tmp_path, "empty.xml", "")
    put(tmp_path, "z.bin", b"\x00\xff")
    got = {r.uri.removeprefix(str(tmp_path)): (r.content_type, r.text, r.bytes) for r in read_files(spark, str(tmp_path)).collect()}
    assert got == {
        "/a/x.xml": ("XML", "<x/>", None),
        "/a/b/y.txt": ("TEXT", "héllo", None),
        "/z.bin": ("BINARY", None, bytearray(b"\x00\xff")),
    }
    assert len(docs(read_files(spark, str(tmp_path), r".*\.xml"))) == 1
    # the pattern must match the whole name
    assert not docs(read_files(spark, str(tmp_path), "x"))


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_files(spark, str(tmp_path / "none")).collect()


def test_bad_utf8_is_replaced_and_unknown_charset_rejected(spark, tmp_path):
    put(tmp_path, "a.txt", b"a\xffb")
    assert list(docs(read_files(spark, str(tmp_path))).values()) == ["a�b"]
    with pytest.raises(LookupError):
        read_files(spark, str(tmp_path), encoding="no-such-charset")


# delimited text


def read_rows(spark, path, **kw):
    return read_csv_docs(spark, path, root_name="r", **kw)


def test_csv_quotes_newlines_blank_lines(spark, tmp_path):
    put(tmp_path, "a.csv", 'first,last\n"george,W",washington\n\n"george b"",\nI", "washington" \n  john , adams  \n" keep ",x\n')
    got = docs(read_rows(spark, str(tmp_path)))
    assert got == {
        "george,W": "<r><first><![CDATA[george,W]]></first><last><![CDATA[washington]]></last></r>",
        "george%20b%22,%0AI": '<r><first><![CDATA[george b",\nI]]></first><last><![CDATA[washington]]></last></r>',
        "john": "<r><first><![CDATA[john]]></first><last><![CDATA[adams]]></last></r>",
        "%20keep%20": "<r><first><![CDATA[ keep ]]></first><last><![CDATA[x]]></last></r>",
    }


@pytest.mark.parametrize("split", [False, True, "quoted"])
def test_csv_rejects(spark, tmp_path, split):
    put(tmp_path, "a.csv", 'id,name\n1,a\n2,b,c\n3\n4,"x"y\n,z\n5,"q""r"\n6,"""t"" u"\n')
    df = read_rows(spark, str(tmp_path), split=split)
    assert sorted(docs(df)) == ["1", "5", "6"]
    assert '"t" u' in docs(df)["6"]
    assert reasons(df) == sorted([WIDTH_REASON, WIDTH_REASON, QUOTE_REASON, "empty uri value"])


def test_csv_each_file_its_header_and_bom(spark, tmp_path):
    put(tmp_path, "a.csv", "﻿first,last\ng,w\nj,a\n")
    put(tmp_path, "b.csv", "k|v,,x\n1,2,3\n")
    put(tmp_path, "c.csv", "")
    got = docs(read_rows(spark, str(tmp_path)))
    assert got == {
        "g": "<r><first><![CDATA[g]]></first><last><![CDATA[w]]></last></r>",
        "j": "<r><first><![CDATA[j]]></first><last><![CDATA[a]]></last></r>",
        "1": "<r><k_v><![CDATA[1]]></k_v><x><![CDATA[3]]></x></r>",
    }


def test_csv_uri_column_absent_fails_its_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "id,name\n1,a\n")
    put(tmp_path, "b.csv", "key,name\n1,a\n")
    df = read_rows(spark, str(tmp_path), uri_id="key")
    assert list(docs(df)) == ["1"]
    assert reasons(df) == ["uri_id key is not found"]


@pytest.mark.parametrize("delimiter, name", [("|", "a.tpch"), ("\t", "a.tab"), (";", "a.txt")])
@pytest.mark.parametrize("split", [False, True])
def test_csv_delimiters(spark, tmp_path, delimiter, name, split):
    put(tmp_path, name, delimiter.join(["k", "v", "w"]) + "\n" + delimiter.join(["1", "", '"a,b"']) + "\n")
    assert docs(read_rows(spark, str(tmp_path), delimiter=delimiter, split=split)) == {
        "1": "<r><k><![CDATA[1]]></k><v><![CDATA[]]></v><w><![CDATA[a,b]]></w></r>"
    }


def test_csv_delimiter_must_be_one_character(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv_docs(spark, str(tmp_path), delimiter="||")


def test_csv_json_types_and_generated_uris(spark, tmp_path):
    path = put(tmp_path, "a.csv", "name,soldOut,price\na,true,1\nb,maybe,2\nc,false,\n")
    for split in (False, True):
        df = read_csv_docs(spark, str(tmp_path), doc_type="JSON", data_type="soldOut,Boolean,price,Number", generate_uri=True, split=split)
        # a rejected row takes no number
        assert docs(df) == {
            f"{path}-0-1": '{"name":"a","soldOut":true,"price":1}',
            f"{path}-0-2": '{"name":"c","soldOut":false}',
        }
        assert reasons(df) == ["Value maybe is not type BOOLEAN"]


def test_csv_other_charset(spark, tmp_path):
    put(tmp_path, "a.csv", "k,v\n1,é\n".encode("utf-16"))
    assert "é" in docs(read_rows(spark, str(tmp_path), encoding="utf-16"))["1"]


def test_csv_small_splits_lose_nothing(spark, tmp_path):
    """Many small blocks over multi-byte text: every row once, each with a URI of its own."""
    rows = [(str(i), "é" * (i % 17), "日本" * (i % 5)) for i in range(3000)]
    put(tmp_path, "a.csv", "id,a,b\n" + "".join(",".join(r) + "\n" for r in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        by_id = docs(read_rows(spark, str(tmp_path), uri_id="id", split=True))
        generated = docs(read_rows(spark, str(tmp_path), generate_uri=True, split=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert by_id == {i: f"<r><id><![CDATA[{i}]]></id><a><![CDATA[{a}]]></a><b><![CDATA[{b}]]></b></r>" for i, a, b in rows}
    assert sorted(generated.values()) == sorted(by_id.values())


@pytest.mark.parametrize("split", [True, "quoted"])
def test_csv_headers_are_sought_among_first_lines(spark, tmp_path, monkeypatch, split):
    """A header is taken from a line per block: grouping all lines would sort them in their task. It may lie behind blank blocks."""
    for name, blank in (("a.csv", 0), ("b.csv", 2500)):
        put(tmp_path, name, "\n" * blank + "\ufeff"[:blank] + "id,v\n" + "".join(f"{name}{i},x\n" for i in range(500)))
    kind, grouped = type(spark.range(1)), []
    plain = kind.groupBy
    monkeypatch.setattr(kind, "groupBy", lambda df, *by: (grouped.append(df) if by == ("src_id",) else None, plain(df, *by))[1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert len(docs(read_rows(spark, str(tmp_path), split=split))) == 1000
        assert [df.count() <= df.select("src_id", "block").distinct().count() for df in grouped] == [True]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("block", [200, 100_000])
def test_csv_quoted_line_breaks_over_small_blocks(spark, tmp_path, block):
    """Records that span lines and blocks: every row once, as one task would read it."""
    rng = random.Random(block)
    for name in ("a.csv", "b.csv"):
        rows = [(f"{name}{i}", "".join(rng.choice(['x', '\n', '""', ',', 'é', ' y']) for _ in range(rng.randrange(9)))) for i in range(120)]
        put(tmp_path, name, "\nid,v\n" + "\n".join(f'{i},"{v}"' if rng.random() < 0.8 or v.strip(' xyé') else f"{i},{v}" for i, v in rows) + "\n")
    want = docs(read_rows(spark, str(tmp_path), uri_id="id"))
    assert len(want) == 240
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        assert docs(read_rows(spark, str(tmp_path), uri_id="id", split="quoted")) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_quoted_split_wants_one_header_and_a_uri_column(spark, tmp_path):
    put(tmp_path, "a.csv", "id,v\n1,a\n")
    put(tmp_path, "b.csv", "id,w\n1,a\n")
    with pytest.raises(ValueError, match="share one header"):
        read_rows(spark, str(tmp_path), split="quoted")
    with pytest.raises(ValueError, match="URI column"):
        read_rows(spark, str(tmp_path), split="quoted", generate_uri=True)


FIELD = st.text(alphabet='ab ,"\n\té|', max_size=6).map(str.strip)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD), min_size=1, max_size=20))
def test_csv_round_trip(spark, tmp_path_factory, rows):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
    writer.writerow(["id", "a", "b"])
    writer.writerows((i, a, b) for i, (a, b) in enumerate(rows))
    path = put(tmp_path_factory.mktemp("csv"), "a.csv", out.getvalue())
    want = {str(i): f"<r><id><![CDATA[{i}]]></id><a><![CDATA[{a}]]></a><b><![CDATA[{b}]]></b></r>" for i, (a, b) in enumerate(rows)}
    assert docs(read_rows(spark, path)) == want
    assert docs(read_rows(spark, path, split="quoted")) == want
    if not any("\n" in x for r in rows for x in r):
        assert docs(read_rows(spark, path, split=True)) == want


# newline-delimited JSON


def test_ndjson_hostile_lines(spark, tmp_path):
    lines = [
        '{"name": "a", "x": 1}', '{"team": {"name": "b"}}', "", "  ", ' {"name": "c"}', "[1, {\"name\": 2.5}]",
        '{"name": {"no": 1}}', '{"name": ', "7", '{"other": 1}', '{"name": true}', '{"name": "x", "name": "y"}', "{'name': 'z'}",
        '{"name": NaN}', '{"a": [{"b": 1}, {"name": 12345678901234567890}]}',
    ]
    put(tmp_path, "a.json", "\n".join(lines))
    df = read_ndjson(spark, str(tmp_path), uri_id="name")
    assert docs(df) == {"a": lines[0], "b": lines[1], "2.5": lines[5], "12345678901234567890": lines[14], "y": lines[11]}
    assert reasons(df) == sorted(["empty lines", "empty lines", "leading space", NO_URI, *["invalid JSON"] * 4, NO_URI, NO_URI])


def test_ndjson_generated_uris_count_good_lines(spark, tmp_path):
    path = put(tmp_path, "a.json", '{"a": 1}\n\n{"b": 2}\n')
    df = read_ndjson(spark, str(tmp_path))
    assert docs(df) == {f"{path}-0-1": '{"a": 1}', f"{path}-0-2": '{"b": 2}'}
    assert {r.line for r in df.collect()} == {1, 2, 3}


def test_ndjson_zip(spark, tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x.json", '{"id": "p"}\n{"id": "q"}')
        z.writestr("empty.json", "")
    df = read_ndjson_zip(spark, path, uri_id="id", filename_as_collection=True)
    assert docs(df) == {"p": '{"id": "p"}', "q": '{"id": "q"}'}
    assert {tuple(r.collections) for r in df.collect()} == {("a.zip_x.json",)}


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text("ab", max_size=2),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["id", "a", "b"]), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from(["id", "a", "b"]), JSON, max_size=3))
def test_breadth_first_search(value):
    """The shallowest holder of the key decides."""
    level, want = [value], None
    while level:
        holder = next((n for n in level if isinstance(n, dict) and "id" in n), None)
        if holder is not None:
            v = holder["id"]
            want = str(v) if isinstance(v, str | int) and not isinstance(v, bool) else None
            break
        level = [
            c for n in level for c in (n.values() if isinstance(n, dict) else n) if isinstance(c, dict | list)
        ]
    assert _find(json.dumps(value), "id") == want


# aggregate XML

AGGREGATE = """<?xml version="1.0"?>
<!-- head -->
<root xmlns="urn:d" xmlns:m="urn:m">
  <r>
    <m:p pid="1" q='a>b'><id>x1</id><!-- c --><![CDATA[<raw>]]><?pi data?></m:p>
    <p pid="2"><id>x2</id></p>
    <m:p pid="3" xmlns:m="urn:m"><m:e/></m:p>
    <m:p/>
  </r>
</root>
"""


def test_xml_records_by_attribute(spark, tmp_path):
    put(tmp_path, "a.xml", AGGREGATE)
    df = read_xml_records(spark, str(tmp_path), element="p", ns="urn:m", uri_id="@pid")
    assert docs(df) == {
        "1": "<m:p xmlns=\"urn:d\" xmlns:m=\"urn:m\" pid=\"1\" q='a>b'><id>x1</id><!-- c --><![CDATA[<raw>]]><?pi data?></m:p>",
        "3": '<m:p xmlns="urn:d" pid="3" xmlns:m="urn:m"><m:e/></m:p>',
    }
    assert reasons(df) == [NO_ID]


def test_xml_records_by_element_and_default(spark, tmp_path):
    put(tmp_path, "a.xml", AGGREGATE)
    df = read_xml_records(spark, str(tmp_path), element="p", ns="urn:d", uri_id="id")
    assert list(docs(df)) == ["x2"]
    assert not docs(read_xml_records(spark, str(tmp_path), element="p", uri_id="id"))
    path = put(tmp_path, "b/b.xml", "<set><rec><a>1</a></rec><other/><rec><a>2</a></rec></set>")
    got = docs(read_xml_records(spark, path))
    assert got == {f"{path}-0-1": "<rec><a>1</a></rec>", f"{path}-0-2": "<rec><a>2</a></rec>"}


def test_xml_records_malformed_file_keeps_what_came_before(spark, tmp_path):
    put(tmp_path, "a.xml", "<s><r><id>1</id></r><r><id>2</id></s>")
    put(tmp_path, "b.xml", "<s><r><id>3</id></r></s>")
    df = read_xml_records(spark, str(tmp_path), element="r", uri_id="id")
    assert sorted(docs(df)) == ["1", "3"]
    assert len(reasons(df)) == 1 and reasons(df)[0].startswith("malformed XML")


def test_xml_records_large_stream_and_charset(spark, tmp_path):
    body = "".join(f"<r><id>{i}</id><t>{'é' * 50}</t></r>" for i in range(5000))
    put(tmp_path, "a.xml", f'<?xml version="1.0" encoding="ISO-8859-1"?><s>{body}</s>'.encode("latin-1"))
    got = docs(read_xml_records(spark, str(tmp_path), element="r", uri_id="id"))
    assert len(got) == 5000 and got["4999"].endswith("é" * 50 + "</t></r>")


def test_xml_records_split_small_blocks(spark, tmp_path):
    body = "\n".join(f'<r n="{i}"><t>{"日" * (i % 9)}</t></r>' for i in range(2000))
    put(tmp_path, "a.xml", f"<s>{body}</s>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = docs(read_xml_records(spark, str(tmp_path), element="r", uri_id="@n", split=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f'<r n="{i}"><t>{"日" * (i % 9)}</t></r>' for i in range(2000)}


# containers


def test_zip_entries(spark, tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("d/x.txt", "one", zipfile.ZIP_STORED)
        z.writestr("/abs.xml", "<a/>" * 100_000, zipfile.ZIP_DEFLATED)
        z.writestr("empty.txt", "")
        z.mkdir("dir")
        z.writestr("lzma.txt", "x", zipfile.ZIP_LZMA)
    put(tmp_path, "bad.zip", b"no zip at all")
    df = read_zip_docs(spark, str(tmp_path), r".*\.zip")
    assert docs(df) == {f"{path}/d/x.txt": "one", "/abs.xml": "<a/>" * 100_000}
    assert "unsupported compression method" in reasons(df)
    assert any(r.startswith("invalid archive") for r in reasons(df))


def test_one_zip_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(200):
            z.writestr(f"{i}.txt", str(i) * 100)
    df = read_zip_docs(spark, path)
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert len(docs(df)) == list_zip_entries(spark, path).count() == 200


def test_entries_are_spread_by_volume_in_runs(spark, tmp_path):
    for a in range(6):
        with zipfile.ZipFile(tmp_path / f"{a}.zip", "w") as z:
            # a third of all bytes in one archive
            for i in range(20):
                z.writestr(f"{i}.txt", "x" * (50_000 if a == 0 else 20_000))
    spread = spread_entries(list_zip_entries(spark, str(tmp_path)))
    tasks = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("csize").alias("n"), F.countDistinct("src_id").alias("a")).collect()
    total = sum(t.n for t in tasks)
    assert total == 20 * 50_000 + 100 * 20_000 and len(tasks) >= 7
    assert max(t.n for t in tasks) < 1.3 * total / 8 and max(t.a for t in tasks) <= 3


def test_gzip_members_and_suffix(spark, tmp_path):
    put(tmp_path, "a.txt.GZ", gzip.compress(b"one") + gzip.compress(b"two"))
    put(tmp_path, "b.xml.gzip", gzip.compress(b"<b/>"))
    put(tmp_path, "c.gz", b"broken")
    got = {u.rpartition("/")[2]: t for u, t in docs(read_gzip_docs(spark, str(tmp_path))).items()}
    assert got == {"a.txt": "onetwo", "b.xml": "<b/>"}
    assert len(reasons(read_gzip_docs(spark, str(tmp_path)))) == 1


def test_archive_pairs_and_missing_metadata(spark, tmp_path):
    meta = json.dumps({"format": "XML", "collections": ["c"], "permissions": [], "quality": 3, "meta": {}, "properties": [], "naked": False})
    with zipfile.ZipFile(tmp_path / "x-XML.zip", "w") as z:
        z.writestr("/n.naked", meta)
        z.writestr("/a.xml.metadata", meta)
        z.writestr("/a.xml", "<a/>")
        z.writestr("/b.xml", "<b/>")
    with zipfile.ZipFile(tmp_path / "x-OTHER.zip", "w") as z:
        z.writestr("/z", "z")
    df = read_archive(spark, str(tmp_path))
    assert docs(df) == {"/a.xml": "<a/>", "/n": None}
    assert reasons(df) == [MISSING]
    got = {r.uri: (r.quality, r.naked) for r in df.where("skip_reason is null").collect()}
    assert got == {"/a.xml": (3, False), "/n": (3, True)}
    assert sorted(docs(read_archive(spark, str(tmp_path), metadata_optional=True))) == ["/a.xml", "/b.xml", "/n"]


# RDF

STATEMENTS = r"""# comment
<urn:s> <urn:p> "plain" .
<urn:s> <urn:p> "tab\there \"q\" é \\n" .   # note
<urn:s> <urn:p> "bonjour"@fr-CA <urn:g> .
<urn:s> <urn:p> "4711"^^<http://www.w3.org/2001/XMLSchema#unsignedLong> .

_:x <urn:p> _:y .
_:y <urn:p> <urn:o> _:g .
<urn:s> <urn:p> nonsense .
<urn:s> "p" <urn:o> .
"""


def test_nquads(spark, tmp_path):
    put(tmp_path, "a.nq", STATEMENTS)
    rows = read_nquads(spark, str(tmp_path), salt="1").collect()
    good = [r for r in rows if r.skip_reason is None]
    assert len(good) == 6 and len(rows) == 8
    objects = {r.o: r for r in good}
    assert objects["plain"].datatype.endswith("#string")
    assert 'tab\there "q" é \\n' in objects
    assert (objects["bonjour"].lang, objects["bonjour"].datatype, objects["bonjour"].graph) == ("fr-CA", None, "urn:g")
    assert objects["4711"].datatype.endswith("#unsignedLong")
    blank = next(r for r in good if r.o_type == "blank")
    assert objects["urn:o"].s == blank.o != blank.s
    other = read_nquads(spark, str(tmp_path), salt="2").where("o_type = 'blank'").first()
    assert other.o != blank.o


def test_ntriples_reject_graphs(spark, tmp_path):
    put(tmp_path, "a.nt", STATEMENTS)
    assert read_ntriples(spark, str(tmp_path)).where("skip_reason is not null").count() == 4


def test_rdf_json(spark, tmp_path):
    put(tmp_path, "a.rj", json.dumps({"urn:s": {"urn:p": [
        {"value": "v", "type": "literal", "lang": "en"}, {"value": "7", "type": "literal", "datatype": "urn:int"},
        {"value": "urn:o", "type": "uri"}, {"value": "_:b", "type": "bnode"}]}, "_:b": {"urn:p": [{"value": "w", "type": "literal"}]}}))
    put(tmp_path, "bad.rj", "{")
    rows = read_rdf_json(spark, str(tmp_path)).collect()
    good = [r for r in rows if r.skip_reason is None]
    literals = {r.o: (r.lang, r.datatype) for r in good if r.o_type == "literal"}
    assert literals == {"v": ("en", None), "7": (None, "urn:int"), "w": (None, "http://www.w3.org/2001/XMLSchema#string")}
    assert next(r.o for r in good if r.o_type == "blank") == next(r.s for r in good if r.o == "w")
    assert len(rows) == 6


def test_csv_headers_stay_with_their_rows(spark, tmp_path):
    """Any number of headers is one plan without a list of them."""
    for i in range(60):
        (tmp_path / f"f{i:02}.csv").write_text(f'id,n,flag,"t""{i}",n{i}\n{i},"1,0{i:02}.50",,"a\\b/""é",{i}\nx{i},q,TRUE,,\n')
    docs = read_csv_docs(spark, str(tmp_path), doc_type="JSON", uri_id="id", data_type="n,Number,flag,Boolean", generate_uri=False)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "n59" not in plan
    rows = docs.select("uri", "text", "skip_reason").collect()
    good = {json.loads(r.text)["id"]: json.loads(r.text) for r in rows if r.skip_reason is None}
    assert good == {str(i): {"id": str(i), "n": 1000 + i + 0.5, f't"{i}': 'a\\b/"é', f"n{i}": str(i)} for i in range(60)}
    assert {r.skip_reason for r in rows if r.skip_reason} == {"Value q is not type NUMBER"} and len(rows) == 120
    xml = read_csv_docs(spark, str(tmp_path), uri_id="n7").select("text", "skip_reason").collect()
    assert sum(r.skip_reason == "uri_id n7 is not found" for r in xml) == 118
    assert any("<t_7><![CDATA[a\\b/\"é]]></t_7><n7><![CDATA[7]]></n7>" in (r.text or "") for r in xml)


def test_small_files_share_tasks(spark, tmp_path):
    """Spark gives a task about thirty files however small they are."""
    for k in range(3000):
        (tmp_path / f"{k}.txt").write_text(f"t{k}")
    plain = spark.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions()
    docs = read_files(spark, str(tmp_path))
    tasks = docs.where("skip_reason is null").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks <= 8 * spark.sparkContext.defaultParallelism < plain
    assert {r.text for r in docs.collect()} == {f"t{k}" for k in range(3000)}
