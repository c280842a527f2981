"""Many small files: tasks list and read them, the driver holds none of their names."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docspark.sources import listing
from docspark.sources.delimited import read_csv_docs
from docspark.sources.files import list_files, read_contents, read_file_refs, read_files
from docspark.sources.zipped import read_gzip_docs

N = 300


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    ids = spark.range(1, N + 1)
    docs = ids.selectExpr(
        "id as doc_id", "concat(repeat(concat('text ', id, ' '), if(id % 3 = 0, 200, 3)), 'é')  as text", "'en' as lang",
        "concat('src', id % 7) as source", "length(text) as n_chars",
    )
    docs.coalesce(1).write.parquet(f"{d}/documents.parquet")
    customers = ids.selectExpr(
        "id as c_custkey", "concat('Customer#', id) as c_name", "cast(id % 5 as int) as c_nationkey", "id / 2 as c_acctbal",
        "if(id % 2 = 0, 'A+B %41', 'BUILDING') as c_mktsegment",
    )
    customers.coalesce(1).write.parquet(f"{d}/customer.parquet")
    spark.range(5).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name").write.parquet(f"{d}/nation.parquet")
    return d


WANT = {
    "foreach_kv": "select c_name as key, c_mktsegment as value from customer",
    "read_gzip_docs": "select concat('/', source, '/', doc_id, '.txt') as uri, md5(text) as text_md5 from documents",
    "export_large_entries": "select concat('/', source, '/', doc_id, '.txt') as uri, md5(text) as text_md5 from documents",
    "read_csv_header_per_file": "select concat('/h/', c_custkey) as uri, c_name as name from customer",
    "link_count_files": "select n_name as title, count(*) as n from customer join nation on n_nationkey = c_nationkey group by n_name",
    "filename_as_collection": "select concat(doc_id, '.txt') as collection, md5(text) as text_md5 from documents",
    "read_file_refs": "select concat('/', source, '/', doc_id, '.txt') as uri, octet_length(text) as bytes_n from documents",
    "read_files": "select concat('/', source, '/', doc_id, '.txt') as uri, md5(text) as text_md5, 'TEXT' as content_type from documents",
}


@pytest.mark.parametrize("name", WANT)
def test_queries_over_a_file_per_row_list_nothing_on_the_driver(spark, made, name):
    for t in ("documents", "customer", "nation"):
        spark.read.parquet(f"{made}/{t}.parquet").createOrReplaceTempView(t)
    df = entry.queries()[name](spark, made)
    assert len(df.inputFiles()) < N / 2
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, spark.sql(WANT[name]).collect()))


@pytest.mark.parametrize("ending", ["txt", "csv", "gz"])
@pytest.mark.parametrize("read", [list_files, read_files, read_file_refs, read_gzip_docs, read_csv_docs])
def test_readers_hold_no_file_names_on_the_driver(spark, tmp_path, read, ending):
    for k in range(40):
        (tmp_path / f"{k}.{ending}").write_bytes(gzip.compress(b"id,a\n1,2\n") if ending == "gz" else b"id,a\n1,2\n")
    df = read(spark, str(tmp_path), rf".*\.{ending}") if read is not read_csv_docs else read(spark, str(tmp_path))
    assert not [f for f in df.inputFiles() if str(tmp_path) in f]
    assert df.count() == 40


def _tree(top):
    names = ["a b.txt", "a+b", "a%20b", "a#b", "a?b", "a[1]", "_h", "_h=1", ".dot", "_metadata", "x._COPYING_", "_metadatax/y", "d=1/z", "_q=1/z", "_no/z", ".git/z"]
    names += [f"deep/{i}/{j}/f{k}.xml" for i in range(3) for j in range(3) for k in range(4)]
    for n in names:
        (top / n).parent.mkdir(parents=True, exist_ok=True)
        (top / n).write_text(n)
    (top / "empty").touch()
    os.symlink("/nowhere-at-all", top / "broken")
    os.symlink(top / "deep" / "1", top / "linked")


def _both(spark, paths):
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return sorted(map(tuple, scan.select("path", "content").collect())), sorted(map(tuple, read_contents(spark, paths).collect()))


@pytest.mark.parametrize("enough", [3, 50_000])
def test_the_files_are_those_of_a_scan(spark, tmp_path, monkeypatch, enough):
    """Hidden and empty files, links, roots below roots, globs; in one round or many."""
    _tree(tmp_path)
    monkeypatch.setattr(listing, "ENOUGH", enough)
    t = str(tmp_path)
    for paths in ([t], [t, t + "/"], [t, f"{t}/deep/1", f"{t}/_no", f"{t}/a b.txt", f"{t}/_h"], [f"{t}/deep/*/2"], [f"{t}/{{_no,deep}}"], [f"{t}/empty"]):
        scanned, got = _both(spark, paths)
        assert got == scanned and len({p for p, _ in got}) == len(got)
    assert len(_both(spark, [t])[1]) > 50


def test_one_missing_path_of_several_is_an_error(spark, tmp_path):
    (tmp_path / "a").write_text("a")
    for missing in ("none", "none*"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read_files(spark, [str(tmp_path / "a"), str(tmp_path / missing)]).collect()


def test_names_match_as_in_a_scan(spark, tmp_path):
    _tree(tmp_path)
    names = lambda pattern: {r.file_name for r in list_files(spark, str(tmp_path), pattern).collect()}
    assert names("a%20b.txt") == {"a b.txt"} and names("a%2520b|a.b") == {"a%20b", "a+b"} and names("f1[.]xml") == {"f1.xml"}


def test_files_are_dealt_by_volume(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "LEAST_BYTES", 1 << 16)
    for k in range(16):
        d = tmp_path / str(k % 4)
        d.mkdir(exist_ok=True)
        (d / f"{k}.bin").write_bytes(bytes([k]) * 100_000)
    files = listing.list_below(spark, [str(tmp_path)])
    tasks = files.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 16 and all(r["count"] == 1 for r in tasks)
    read = listing.with_content(files).selectExpr("content", "length(content) as n").collect()
    assert {bytes(r.content[:1])[0] for r in read} == set(range(16)) and all(r.n == 100_000 for r in read)


def test_contents_come_in_bounded_batches(monkeypatch, tmp_path):
    import pyarrow as pa

    for k in range(10):
        (tmp_path / f"{k}").write_bytes(b"x" * (5000 if k == 4 else 400))
    monkeypatch.setattr(listing, "BATCH_BYTES", 1000)
    rows = [(f"file:{tmp_path}/{k}", 5000 if k == 4 else 400) for k in range(10)]
    batch = pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows]), pa.array([n for _, n in rows])], names=["path", "length"])
    out = list(listing._read(iter([batch])))
    assert [b.num_rows for b in out] == [2, 2, 1, 2, 2, 1] and [p for b in out for p in b.column(0).to_pylist()] == [p for p, _ in rows]


def test_a_store_that_only_spark_opens_is_read_by_spark(spark, tmp_path, monkeypatch):
    _tree(tmp_path)
    monkeypatch.setattr(listing, "_opens", lambda path: False)
    assert listing.list_below(spark, [str(tmp_path)]) is None
    scanned, got = _both(spark, [str(tmp_path)])
    assert got == scanned
    assert {r.text for r in read_files(spark, str(tmp_path), r"f1\.xml").collect()} == {f"deep/{i}/{j}/f1.xml" for i in range(3) for j in range(3)}
