"""Large XML files in blocks give the rows of one parser over the whole file."""

import random

import pytest
from pyspark.sql import functions as F

from docspark.sources import xml_blocks
from docspark.sources.xml_records import read_xml_records

HEAD = '<?xml version="1.0"?>\n<!DOCTYPE s [<!ENTITY e "&#x41;<i/>"><!-- <r id="no"/> -->]>\n'
PARTS = [
    '<r id="{n}"/>',
    '<r id="{n}"><t>{n} &e; 日本</t></r>',
    "<p:r xmlns:p='urn:p' id='{n}'><p:r id='inner'/></p:r>",
    "<!-- <r id='{n}'> ]]> ?> -->",
    "<!----><!-- -->",
    '<r id="{n}"><![CDATA[</r> <r id="x"> <!-- ]] > ]]></r>',
    "<?target <r id='{n}'> --> ]]> ?>",
    "<g xmlns='urn:d' xmlns:q=\"urn:'q'\">\r\n",
    "<h a='x > y \" xmlns:no=\"u\"'>",
    "</g>",
    "</h>",
    "text\rwith\n\n> breaks\r\n",
    '<q:r xmlns:q="urn:q" id="{n}">\n<r id="nested"><id>a</id></r>\n</q:r >',
    '<r\n id="{n}"\t><id> i{n} </id><id>second</id></r>',
]


def document(seed, head=HEAD):
    rng, out, opened = random.Random(seed), [head, "<s xmlns:u='urn:u'>"], []
    for n in range(rng.randrange(20, 60)):
        part = rng.choice(PARTS)
        if part in ("</g>", "</h>"):
            if not opened:
                continue
            part = f"</{opened.pop()}>"
        elif part[:2] in ("<g", "<h"):
            opened.append(part[1])
        out.append(part.replace("{n}", str(n)))
    return "".join(out) + "".join(f"</{x}>" for x in reversed(opened)) + "</s>\n<!-- end <r> -->\n"


BROKEN = {
    "cut.xml": document(100)[:-40],
    "cut2.xml": document(101)[: len(document(101)) // 2],
    "tag.xml": document(102) + "<junk/>",
    "mixed.xml": document(103).replace("</s>", "</t>"),
    "entity.xml": document(104).replace("<r id=", "&undefined;<r id=", 5),
    "open.xml": document(105).replace("<!-- <r", "<!-- -- <r", 1),
    "bad.xml": document(106).replace('<r id="1', '<r <id="1', 3),
    "prefix.xml": document(107).replace("<p:r xmlns:p='urn:p'", "<p:r", 1),
    "none.xml": "no mark-up at all " * 20,
    "prolog.xml": "<!-- only a comment " + "x" * 300 + " -->",
    "latin.xml": document(108, '<?xml version="1.0" encoding="ISO-8859-1"?><!DOCTYPE s [<!ENTITY e "e">]>').replace("日本", "é"),
    "wide.xml": document(109, '<?xml version="1.0" encoding="UTF-16"?><!DOCTYPE s [<!ENTITY e "e">]>'),
    "bom.xml": "﻿" + document(110),
    "cdata.xml": HEAD + "<s><r id='1'><![CDATA[" + "]>]] " * 200 + "]]></r><r id='2'/></s>",
    "deep.xml": HEAD + "<s>" + "<d>" * 60 + "<r id='1'/>" + "</d>" * 60 + "<r id='2'/></s>",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("xml")
    for seed in range(12):
        (top / f"good{seed}.xml").write_bytes(document(seed).encode())
    for name, text in BROKEN.items():
        (top / name).write_bytes(text.encode({"latin.xml": "latin-1", "wide.xml": "utf-16"}.get(name, "utf-8")))
    return str(top)


def rows(df):
    return sorted(map(tuple, df.select("src_id", "line", "col", "uri", "text", "skip_reason").collect()), key=str)


@pytest.mark.parametrize("block", [37, 300])
@pytest.mark.parametrize("kw", [dict(element="r", uri_id="@id"), dict(element="r", ns="urn:p"), dict(uri_id="id")])
def test_same_rows_as_one_task(spark, folder, block, kw):
    want = rows(read_xml_records(spark, folder, **kw))
    assert len(want) > 30
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = rows(read_xml_records(spark, folder, split=True, **kw))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<s>" + "".join(f'<r id="{i}">{"x" * 50}</r>\n' for i in range(2000)) + "</s>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        docs = read_xml_records(spark, str(tmp_path), element="r", uri_id="@id", split=True)
        tasks = docs.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(t["count"] for t in tasks) == 2000 and len(tasks) > 8


def test_scans_of_all_states_meet():
    data = document(3).encode()
    scans = []
    for state in range(4):
        scans.append(xml_blocks._Scan(data, data.index(b"<s "), state, scans))
    assert sum(len(s.at) for s in scans[1:]) < len(scans[0].at)
    assert all(s.end == xml_blocks.TEXT for s in scans)
