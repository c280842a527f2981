import re

import duckdb
import pyarrow.parquet as pq
import pytest

from docspark.llm import mixing
from tests.compare import compare


def sized(table, rows):
    return table([(k, " ".join(["w"] * n), "en", s) for k, (s, n) in enumerate(rows)])


def test_targets_by_hand(table):
    # sizes 100, 300, 50; weights 5, 2, 1; 675 words: a stops at 200, then 475 by 2 : 1, where b gets 316.7 and null stops at 100
    df = sized(table, [("a", 60), ("a", 40), ("b", 300), (None, 50)])
    got = {r["source_size"]: r["target"] for r in mixing.taken(df).collect()}
    assert got == {100: 200.0, 300: 375.0, 50: 100.0}


def test_taken_is_near_its_target(table):
    rows = [(f"s{k % 7}", 1 + (k * 37) % 211) for k in range(400)]
    df = sized(table, rows)
    out = mixing.taken(df).collect()
    by = {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        t = by.setdefault(rows[r["doc_id"]][0], [r["target"], 0])
        t[1] += r["taken"]
    assert all(abs(a - b) <= mixing.BLOCK for a, b in by.values())
    again = mixing.taken(df.repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_mix_cuts_at_words(table):
    rows = [("a", 50)] * 20 + [("b", 1000)]
    df = sized(table, rows)
    want = {r["doc_id"]: r["taken"] for r in mixing.taken(df).collect()}
    got = {}
    for r in mixing.mixed(df).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(mixing.WORD, r["text"]))
    assert got == {k: v for k, v in want.items() if v}
    assert mixing.mixed(df).columns == df.columns


def test_hostile_rows(hostile, tmp_path):
    pq.write_table(hostile.select("doc_id", "text", "source").toArrow(), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    assert compare(mixing.taken(hostile), con, mixing.ORACLE) is None


@pytest.mark.parametrize("rows", [0, 3])
def test_nothing_to_take(hostile, rows):
    df = hostile.filter("text is null or trim(text) = ''").limit(rows)
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.taken(df).collect())
    assert mixing.mixed(df).count() == 0


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.taken(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("MapInArrow", "Python", "Pandas"))


def test_rows_that_share_an_id_are_taken_on_their_own(table):
    text = lambda k, n: " ".join([f"t{k}"] * n)
    rows = [(None, text(k, 20 + k), "en", "a") for k in range(4)] + [(1, text(8, 30), "en", "a"), (1, text(9, 30), "en", "a")]
    rows += [(2, text(7, 10), "en", "a")] * 3 + [(3, text(6, 400), "en", "b")]
    df = table(rows)
    want = sum(r["taken"] for r in mixing.taken(df).collect())
    texts = [r["text"].split() for r in mixing.mixed(df).collect()]
    assert sum(map(len, texts)) == want
    size = {}
    for r in rows:
        word = r[1].split()[0]
        size[word] = size.get(word, 0) + 2 * len(r[1].split())
    for word, most in size.items():
        assert sum(t.count(word) for t in texts) <= most
    assert mixing.mixed(df).columns == df.columns


def test_mix_of_a_table_with_the_names_used_inside(spark, words):
    rows = [(k, words(k, 30), "ab"[k % 2], k, "s", 0.5, "r", "x") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _take long, _size string, size double, _row string, first string")
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.count() > 0
    assert all(r["_take"] == r["doc_id"] and r["_size"] == "s" and r["_row"] == "r" for r in out.collect())
