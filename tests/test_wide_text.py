"""Lines of UTF-16 and UTF-32 files in blocks, against plain decoding."""

import gzip
import random

import pytest

from docspark.sources.delimited import read_csv_docs
from docspark.sources.files import list_files
from docspark.sources.ndjson import read_ndjson
from docspark.sources.rdf import read_nquads
from docspark.sources.wide_text import read_wide_lines

# characters whose bytes look like line ends of the other byte order, or across two characters
HOSTILE = ["ab", "ਅĀ", "਀\u000b", "ഊ", "😀", "", "é" * 9, "ਊ഍", "\u000b਀", "x\U0001000ay"]


def _text(seed, breaks):
    rng = random.Random(seed)
    return "".join("".join(rng.choice(HOSTILE) for _ in range(rng.randrange(5))) + rng.choice(breaks) for _ in range(40))


def _rows(df):
    """The lines of each file in the order of blocks."""
    rows = {}
    for i, r in enumerate(df.collect()):
        rows.setdefault(r.src_id.rpartition("/")[2], []).append((r.block, i, r.value))
    return {name: [v for _, _, v in sorted(found)] for name, found in rows.items()}


def _want(text, only_lf):
    text = text.removeprefix("﻿")
    if not only_lf:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    lines = text.split("\n")
    return lines[:-1] if lines[-1] == "" else lines


@pytest.mark.parametrize(
    ("charset", "size"), [("utf-16-le", 4), ("utf-32", 4), ("utf-16", 12), ("utf-16-be", 60), ("utf-32-le", 60), ("utf-32-be", 1 << 20)]
)
def test_lines_of_blocks(spark, tmp_path, charset, size):
    want = {}
    for only_lf in (False, True):
        for k in range(3):
            text = _text(k, ["\n", "\r\n", "\r"] if k < 2 else ["\n"]) + ("last" if k else "")
            # without an order in the name the mark tells it; without a mark the units are big-endian
            data = text.encode(charset) if k else text.encode(charset if charset[-3] == "-" and charset[-1] == "e" else charset + "-be")
            (tmp_path / f"{k}.txt").write_bytes(data)
            want[f"{k}.txt"] = _want(text, only_lf)
            (tmp_path / f"{k}.gz").write_bytes(gzip.compress(data))
            want[f"{k}.gz"] = want[f"{k}.txt"]
        (tmp_path / "empty").write_bytes(b"")
        got = _rows(read_wide_lines(list_files(spark, str(tmp_path)), charset, only_lf, size))
        assert got == {name: lines for name, lines in want.items() if lines}


def test_mark_alone_and_broken_units(spark, tmp_path):
    (tmp_path / "mark").write_bytes(b"\xff\xfe")
    (tmp_path / "odd").write_bytes("a\nb".encode("utf-16-le") + b"c")
    got = _rows(read_wide_lines(list_files(spark, str(tmp_path)), "utf-16-le", size=4))
    assert set(got) == {"odd"} and got["odd"][0] == "a" and got["odd"][1][0] == "b"


def test_readers_over_wide_charsets(spark, tmp_path):
    for name in ("utf-16", "utf-32-be"):
        top = tmp_path / name
        for folder, text in (
            ("json", "".join(f'{{"id": "{i}", "v": "ĀਅĀ"}}\n' for i in range(300)) + " bad\n"),
            ("csv", "id,v\r\n" + "".join(f"{i},é{i}\r\n" for i in range(300))),
            ("quoted", "id,v\r\n" + "".join(f'{i},"é\nx{i}"\r\n' for i in range(300))),
            ("nq", "".join(f'<urn:{i}> <urn:p> "ਅ{i}" <urn:g> .\n' for i in range(300))),
        ):
            (top / folder).mkdir(parents=True)
            (top / folder / "a.txt").write_bytes(text.encode(name))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        try:
            rows = read_ndjson(spark, str(top / "json"), uri_id="id", encoding=name).collect()
            assert {r.uri for r in rows if r.uri} == {str(i) for i in range(300)} and rows[0].text.endswith('"ĀਅĀ"}')
            assert [r.skip_reason for r in rows if r.skip_reason] == ["leading space"]
            lines = sorted((r.line, int(r.uri)) for r in rows if r.uri)
            assert [u for _, u in lines] == list(range(300))
            for split, folder, value in ((True, "csv", "é7"), ("quoted", "quoted", "é\\nx7")):
                docs = read_csv_docs(spark, str(top / folder), uri_id="id", split=split, doc_type="JSON", encoding=name).collect()
                assert sorted(int(r.uri) for r in docs) == list(range(300))
                assert f'"{value}"' in next(r.text for r in docs if r.uri == "7")
            assert {r.o for r in read_nquads(spark, str(top / "nq"), encoding=name).collect()} == {f"ਅ{i}" for i in range(300)}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
