"""Failed documents of a load, and batches that are loaded again."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from docspark.plans import jobs
from docspark.schema import to_docs
from docspark.sinks.records import foreach_kv, foreach_reported
from docspark.sinks.store import compact_store, is_applied, scan_docs, upsert_docs, write_store
from docspark.sources.files import read_file_refs


def _docs(spark, rows):
    return to_docs(spark.createDataFrame(rows, "uri string, text string"), content_type=F.lit("TEXT"))


def _uris(spark, store):
    return sorted(r.uri for r in scan_docs(spark, store).collect())


def _files(path):
    return sorted(str(p) for p in Path(path).rglob("*.parquet"))


def test_lost_and_damaged_references_are_failures(spark, tmp_path):
    inbox, store, rejects = (tmp_path / x for x in ("in", "store", "rejects"))
    inbox.mkdir()
    for name in ("a.bin", "gone.bin", "b.bin"):
        (inbox / name).write_bytes(name.encode())
    packed = gzip.compress(b"x" * 5000)
    (inbox / "cut.gz").write_bytes(packed[: len(packed) // 2])
    refs = read_file_refs(spark, str(inbox)).withColumn("ref", F.when(F.col("src_id").endswith(".gz"), "gzip").otherwise("file"))
    rows = spark.createDataFrame(refs.collect(), refs.schema)  # listed before a file goes
    (inbox / "gone.bin").rename(tmp_path / "elsewhere.bin")
    plain = _docs(spark, [("/t", "text"), ("/bad", None)]).withColumn("skip_reason", F.when(F.col("text").isNull(), "empty"))
    docs = rows.unionByName(plain, allowMissingColumns=True)
    report = jobs.import_docs(docs, str(store), str(rejects)).first()
    assert tuple(report) == (6, 6, 5, 3, 2)
    assert sorted(u.rpartition("/")[2] for u in _uris(spark, str(store))) == ["a.bin", "b.bin", "t"]
    listed = {(r.uri or "").rpartition("/")[2]: r.skip_reason for r in spark.read.parquet(str(rejects)).collect()}
    assert set(listed) == {"", "cut.gz", "gone.bin"} and listed[""] == "empty" and listed["gone.bin"].startswith("not stored: FileNotFoundError")


def test_sink_that_refuses_documents(spark, tmp_path):
    docs = _docs(spark, [(f"/{i}", str(i)) for i in range(50)])
    out = str(tmp_path)

    def put(row):
        if int(row.text) % 10 == 3:
            raise ValueError(f"no room for {row.text}")
        Path(out, row.text).write_text(row.text)

    rejects = str(tmp_path / "rejects")
    report = jobs.import_docs(docs, "", rejects, sink=lambda good: foreach_reported(good, put)).first()
    assert tuple(report) == (50, 50, 50, 45, 5)
    assert {r.uri: r.skip_reason for r in spark.read.parquet(rejects).collect()} == {f"/{i}": f"ValueError: no room for {i}" for i in (3, 13, 23, 33, 43)}
    assert foreach_reported(docs.where("false"), put).count() == 0


def test_a_batch_loaded_twice_counts_once(spark, tmp_path):
    store, rejects = str(tmp_path / "store"), str(tmp_path / "rejects")
    docs = _docs(spark, [("/1", "a"), ("/2", None)]).withColumn("skip_reason", F.when(F.col("text").isNull(), "empty"))
    assert tuple(jobs.import_docs(docs, store, rejects, load_id=("job", 0)).first()) == (2, 2, 1, 1, 0)
    files, listed = _files(store), _files(rejects)
    assert tuple(jobs.import_docs(docs, store, rejects, load_id=("job", 0)).first()) == (0, 0, 0, 0, 0)
    assert (_files(store), _files(rejects)) == (files, listed)
    # a batch that broke between its rejects and its load writes its rejects again, in their place
    other = _docs(spark, [("/3", None)]).withColumn("skip_reason", F.lit("empty"))
    for _ in range(2):
        jobs.import_docs(other, store, rejects, load_id=("job", 1))
    assert spark.read.parquet(rejects).count() == 2
    jobs.import_docs(docs, store, rejects, load_id=("other job", 0))
    jobs.import_docs(docs, store, rejects)
    assert spark.read.parquet(rejects).count() == 4 and _uris(spark, store) == ["/1"]


def test_batches_outlive_compaction(spark, tmp_path):
    store = str(tmp_path / "store")
    upsert_docs(_docs(spark, [("/1", "a")]), store, load_id=("job", 7))
    upsert_docs(_docs(spark, [("/2", "b")]), store)
    compact_store(spark, store)
    assert is_applied(spark, store, ("job", 7)) and is_applied(spark, store, ("job", 6)) and not is_applied(spark, store, ("job", 8))
    upsert_docs(_docs(spark, [("/1", "again")]), store, load_id=("job", 7))
    assert {r.uri: r.text for r in scan_docs(spark, store).collect()} == {"/1": "a", "/2": "b"}
    write_store(_docs(spark, [("/1", "new")]), store, mode="clean")
    assert not is_applied(spark, store, ("job", 7)) and not is_applied(spark, str(tmp_path / "none"), ("job", 0))


def test_pairs_are_spread_over_tasks_by_key(spark, tmp_path):
    """A table of one partition still runs its statements in many tasks; calls of one key stay together."""
    out = str(tmp_path)

    def setup():
        import uuid

        name = f"{out}/{uuid.uuid4().hex}"

        def statement(key, value):
            with open(name, "a") as f:
                f.write(f"{key} {value}\n")

        return statement

    pairs = spark.range(400).coalesce(1).selectExpr("if(id = 7, null, cast(id % 100 as string)) as key", "id as value")
    foreach_kv(pairs, None, setup)
    calls = [[line.split() for line in p.read_text().splitlines()] for p in tmp_path.iterdir()]
    assert sorted(int(v) for task in calls for _, v in task) == list(range(400)) and len(calls) > 10
    owners = {}
    for n, task in enumerate(calls):
        for key, _ in task:
            owners.setdefault(key, set()).add(n)
    assert all(len(o) == 1 for o in owners.values())
