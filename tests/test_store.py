"""Stores, exports and jobs."""

import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docspark.plans import jobs
from docspark.runtime import ship
from docspark.schema import to_docs
from docspark.sinks.export import _drop_strays, export_archive, export_files, export_zip
from docspark.sinks.store import compact_store, prepare_target, scan_docs, store_buckets, upsert_docs, write_store
from docspark.sources.archive import read_archive
from docspark.sources.files import read_file_refs, read_files
from docspark.sources.rdf import read_nquads
from docspark.streaming.imports import import_stream, ndjson_stream


def make(spark, rows, **columns):
    return to_docs(spark.createDataFrame(rows, "uri string, text string, line long"), content_type=F.lit("TEXT"), **columns)


def content(spark, path, **scope):
    return {r.uri: r.text for r in scan_docs(spark, path, **scope).collect()}


def test_upsert_replaces_inserts_and_repeats(spark, tmp_path):
    path = str(tmp_path / "store")
    write_store(make(spark, [(f"/{i}", "old", i) for i in range(200)]), path, buckets=5)
    change = make(spark, [("/3", "first", 1), ("/3", "last", 2), ("/new", "n", 1)], src_id=F.lit("s"))
    for _ in range(2):
        upsert_docs(change, path, buckets=99)
        got = content(spark, path)
        assert len(got) == 201 and got["/3"] == "last" and got["/new"] == "n" and got["/4"] == "old"
    assert store_buckets(spark, path) == 5
    upsert_docs(change.where("false"), path)
    assert len(content(spark, path)) == 201


def test_upsert_with_one_uri_many_times(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "/hot").otherwise(F.concat(F.lit("/"), F.col("id").cast("string"))).alias("uri"),
        F.col("id").cast("string").alias("text"), F.col("id").alias("line"),
    )
    upsert_docs(to_docs(rows, src_id=F.lit("s")), path, buckets=4)
    assert content(spark, path, directories=["/"])["/hot"] == "19998"


def test_upsert_writes_in_proportion_to_the_load(spark, tmp_path):
    path = tmp_path / "store"
    write_store(make(spark, [(f"/{i}", f"{i} " * 500, i) for i in range(5_000)]), str(path), buckets=8)
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    size = sum(p.stat().st_size for p in before)
    upsert_docs(make(spark, [(f"/{i}", "new", 0) for i in range(5)]), str(path))
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items())
    assert sum(p.stat().st_size for p in path.rglob("*.parquet") if p not in before) < size / 5
    got = content(spark, str(path))
    assert len(got) == 5_000 and got["/3"] == "new" and got["/5"] == "5 " * 500


def test_older_versions_are_read_by_stamp(spark, tmp_path):
    path = str(tmp_path / "store")
    for stamp, text in ((10, "v1"), (20, "v2"), (30, "v3")):
        upsert_docs(make(spark, [("/a", text, 0), (f"/{stamp}", "own", 0)], created_ts=F.lit(stamp)), path)
    versions = {t: content(spark, path, as_of=t).get("/a") for t in (5, 10, 15, 20, 29, 99)}
    assert versions == {5: None, 10: "v1", 15: "v1", 20: "v2", 29: "v2", 99: "v3"}
    assert content(spark, path) == {"/a": "v3", "/10": "own", "/20": "own", "/30": "own"}
    compact_store(spark, path, buckets=3)
    assert content(spark, path) == {"/a": "v3", "/10": "own", "/20": "own", "/30": "own"} and store_buckets(spark, path) == 3
    assert len([p for p in Path(path).iterdir() if p.name.startswith("version=")]) == 1


def test_a_load_that_breaks_leaves_the_store_as_it_was(spark, tmp_path):
    path = str(tmp_path / "store")
    write_store(make(spark, [("/1", "a", 0)]), path)
    bad = make(spark, [("/1", "b", 0)]).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    for load in (lambda: upsert_docs(bad, path), lambda: write_store(bad, path, mode="clean")):
        with pytest.raises(Exception):  # noqa: B017
            load()
        assert content(spark, path) == {"/1": "a"}
    # a load that nothing names is not read
    make(spark, [("/9", "x", 0)]).write.parquet(f"{path}/version=000009-broken")
    assert content(spark, path) == {"/1": "a"}


def test_a_store_can_be_loaded_onto_itself(spark, tmp_path):
    path = str(tmp_path / "store")
    write_store(make(spark, [(f"/{i}", "a", i) for i in range(20)]), path)
    write_store(scan_docs(spark, path).withColumn("text", F.lit("b")), path, mode="clean")
    assert content(spark, path) == {f"/{i}": "b" for i in range(20)}


def test_prepare_target(spark, tmp_path):
    path = str(tmp_path / "t")
    prepare_target(spark, path)
    write_store(make(spark, [("/1", "a", 0)]), path, buckets=2)
    with pytest.raises(FileExistsError):
        write_store(make(spark, [("/2", "b", 0)]), path)
    write_store(make(spark, [("/2", "b", 0)]), path, buckets=3, mode="clean")
    assert content(spark, path) == {"/2": "b"} and store_buckets(spark, path) == 3


def test_scan_switches_prune_columns_and_push_filters(spark, tmp_path):
    path = str(tmp_path / "s")
    write_store(make(spark, [("/a/1", "a", 0), ("/b/1", "b", 0)], collections=F.array(F.lit("c"))), path, buckets=2)
    df = scan_docs(spark, path, directories=["/a"], copy_permissions=False).select("uri")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StringStartsWith(uri,/a/)" in plan and "ReadSchema: struct<uri:string,created_ts:bigint,deleted_ts:bigint>" in plan
    assert "permissions" not in scan_docs(spark, path, copy_permissions=False).columns
    with pytest.raises(ValueError):
        scan_docs(spark, path, collections=["c"], directories=["/a"])


def test_export_files_paths(spark, tmp_path):
    rows = [("/a/b c.txt", "one", 0), ("http://h/x%20y.txt?q", "two", 0), ("../../evil", "no", 0), ("/dir/", "no", 0)]
    listing = export_files(make(spark, rows), str(tmp_path / "out")).collect()
    assert sum(r.error is not None for r in listing) == 2
    files = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert files == {"a/b c.txt": "one", "x y.txt": "two"}


def test_export_encoding_and_references(spark, tmp_path):
    export_files(make(spark, [("/a.txt", "é", 0)]), str(tmp_path / "latin"), encoding="ISO-8859-1")
    assert (tmp_path / "latin" / "a.txt").read_bytes() == b"\xe9"
    refs = read_file_refs(spark, str(tmp_path / "latin"), replace=[("^" + str(tmp_path / "latin"), "")])
    assert refs.columns.count("bytes") == 0
    export_files(refs, str(tmp_path / "copy"))
    assert (tmp_path / "copy" / "a.txt").read_bytes() == b"\xe9"


def test_zips_roll_and_split_by_type(spark, tmp_path):
    rows = make(spark, [(f"/{i}", "x" * 1000, i) for i in range(50)]).coalesce(1)
    mixed = rows.withColumn("content_type", F.when(F.col("line") < 10, "XML").otherwise("TEXT"))
    listing = export_zip(mixed, str(tmp_path), roll_bytes=10_000).collect()
    assert all(r.bytes_n <= 10_000 for r in listing) and sum(r.entries for r in listing) == 50
    names = [Path(r.path).name for r in listing]
    assert sum(n.endswith("-XML.zip") for n in names) == 1 and sum(n.endswith("-TEXT.zip") for n in names) == 4
    for r in listing:
        assert zipfile.ZipFile(r.path.removeprefix("file:")).testzip() is None
    assert not list(tmp_path.glob("_*"))


def test_archives_of_lost_attempts_are_deleted(spark, tmp_path):
    listing = export_zip(make(spark, [(f"/{i}", "x", i) for i in range(9)]).repartition(3), str(tmp_path))
    kept = sorted(p.name for p in tmp_path.glob("*.zip"))
    assert len(kept) == listing.count() == 3
    stamp = "-".join(kept[0].split("-")[:2])
    (tmp_path / f"{stamp}-0-99-000000-TEXT.zip").write_bytes(b"lost")
    (tmp_path / "other-TEXT.zip").write_bytes(b"not ours")
    _drop_strays(f"file:{tmp_path}", stamp, listing)
    assert sorted(p.name for p in tmp_path.glob("*.zip")) == sorted([*kept, "other-TEXT.zip"])


def test_archive_keeps_pairs_together(spark, tmp_path):
    docs = make(spark, [(f"/{i}", "x" * 500, i) for i in range(40)]).coalesce(1)
    export_archive(docs, str(tmp_path), roll_bytes=3000)
    for z in tmp_path.glob("*.zip"):
        names = zipfile.ZipFile(z).namelist()
        assert {n.removesuffix(".metadata") for n in names if n.endswith(".metadata")} == {n for n in names if not n.endswith(".metadata")}
    assert read_archive(spark, str(tmp_path)).where("skip_reason is null").count() == 40


def test_import_copy_export(spark, tmp_path):
    docs = make(spark, [("/1.txt", "a", 1), ("/2.txt", "b", 2), ("/3.txt", None, 3)], collections=F.array(F.lit("in")))
    docs = docs.withColumn("skip_reason", F.when(F.col("text").isNull(), "empty"))
    a, b, rejects = (str(tmp_path / x) for x in ("a", "b", "rejects"))
    report = jobs.import_docs(docs, a, rejects, collections=["all"], permissions="r,read", quality=5).first()
    assert tuple(report) == (3, 3, 2, 2, 0)
    assert [r.skip_reason for r in spark.read.parquet(rejects).collect()] == ["empty"]
    jobs.copy_docs(
        spark, a, b, {"replace": [("^/", "/copied/")]}, collections=["second"], in_collections=["all"],
        copy_permissions=False, rules=[{"column": "text", "kind": "mask"}],
    )
    got = {r.uri: r for r in scan_docs(spark, b).collect()}
    assert set(got) == {"/copied/1.txt", "/copied/2.txt"}
    doc = got["/copied/1.txt"]
    assert (doc.collections, doc.permissions, doc.quality, doc.text) == (["all", "in", "second"], [], 5, "#")
    jobs.export_docs(spark, b, str(tmp_path / "out"))
    assert read_files(spark, str(tmp_path / "out")).count() == 2


def test_import_rejects_what_does_not_parse(spark, tmp_path):
    rows = [("/a.xml", "<a/>", 1), ("/b.xml", "<b>", 2), ("/c.json", '{"c": 1}', 3), ("/d.json", "{", 4), ("/e.txt", "<{", 5)]
    kind = F.upper(F.regexp_extract("uri", "([a-z]+)$", 1))
    docs = make(spark, rows).withColumn("content_type", F.when(kind == "TXT", "TEXT").otherwise(kind))
    jobs.import_docs(docs, str(tmp_path / "s"), str(tmp_path / "r"))
    assert sorted(content(spark, str(tmp_path / "s"))) == ["/a.xml", "/c.json", "/e.txt"]
    assert sorted(r.skip_reason for r in spark.read.parquet(str(tmp_path / "r")).collect()) == ["invalid JSON", "malformed XML"]


def test_import_triples(spark, tmp_path):
    lines = "".join(f"<urn:s{i}> <urn:p> <urn:o> <urn:g{i % 2}> .\n" for i in range(250)) + "junk\n<urn:s> <urn:p> <urn:o> .\n"
    (tmp_path / "a.nq").write_text(lines)
    stored = spark.createDataFrame([("urn:g1", [("owner", "update")])], "graph string, permissions array<struct<role:string,capability:string>>")
    store = str(tmp_path / "s")
    new = jobs.import_triples(
        read_nquads(spark, str(tmp_path / "a.nq")), store, str(tmp_path / "r"), stored, "r,read", output_graph="urn:out"
    )
    assert sorted(r.graph for r in new.collect()) == ["urn:g0", "urn:out"]
    docs = scan_docs(spark, store).collect()
    assert sorted((d.collections[0], d.permissions[0].role, d.text.count("<sem:triple>")) for d in docs) == [
        ("urn:g0", "r", 25), ("urn:g0", "r", 100), ("urn:g1", "owner", 25), ("urn:g1", "owner", 100), ("urn:out", "r", 1)
    ]
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1


def test_scan_as_of_and_output_directory(spark, tmp_path):
    docs = make(spark, [("/1", "a", 0), ("/2", "b", 0), ("/3", "c", 0)])
    docs = docs.withColumn("created_ts", F.when(F.col("uri") == "/2", 20).otherwise(10).cast("long"))
    docs = docs.withColumn("deleted_ts", F.when(F.col("uri") == "/3", 15).otherwise(-1).cast("long"))
    jobs.import_docs(docs, str(tmp_path / "s"), directory="/out")
    assert sorted(content(spark, str(tmp_path / "s"))) == ["/out/1", "/out/2"]
    assert sorted(content(spark, str(tmp_path / "s"), as_of=12)) == ["/out/1", "/out/3"]


def test_import_stream_resumes(spark, tmp_path):
    inbox, store, check = (str(tmp_path / x) for x in ("in", "store", "check"))
    Path(inbox).mkdir()
    Path(inbox, "a.json").write_text('{"id": "1", "v": "a"}\n bad\n')

    def run():
        import_stream(ndjson_stream(spark, inbox, "id", prefix="/"), store, check, str(tmp_path / "rejects"), collections=["s"]).awaitTermination()
        return content(spark, store)

    assert run() == {"/1": '{"id": "1", "v": "a"}'}
    Path(inbox, "b.json").write_text('{"id": "1", "v": "b"}\n{"id": "2"}\n')
    assert run() == {"/1": '{"id": "1", "v": "b"}', "/2": '{"id": "2"}'}
    assert [r.skip_reason for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["leading space"]


def test_executors_get_the_package(spark):
    ship(spark)
    ship(spark)
    listed = [p for p in spark.sparkContext._python_includes if p == "docspark.zip"]
    assert len(listed) == 1
