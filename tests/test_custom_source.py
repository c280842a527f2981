"""The template of a user's source: listing in tasks, filters that it takes, and its stream."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docspark.sources import custom
from docspark.sources.io import resolve


@pytest.fixture
def tree(spark, tmp_path):
    custom.register(spark)
    top = tmp_path / "tree"
    for name in ["a", "b", "d/c", "d/e/f", "d/e/g/h", "d/e/g/i/j", "x/y/z/1", "x/y/z/2", "é/ü", "_h/k", "d/.m", "d/_n/o"]:
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_text(name)
    return top


SEEN = ["a", "b", "d/c", "d/e/f", "d/e/g/h", "d/e/g/i/j", "x/y/z/1", "x/y/z/2", "é/ü"]


def _read(spark, top, **options):
    return spark.read.format("docspark_files").options(**options).load(str(top))


@pytest.mark.parametrize("options", [{}, {"tasks": 1}, {"tasks": 5, "spreadDepth": 0}, {"tasks": 3, "spreadDepth": 1}, {"tasks": 4, "spreadDepth": 9}])
def test_each_file_once(spark, tree, options):
    rows = _read(spark, tree, **options).collect()
    assert sorted(r.uri.removeprefix(f"{tree}/") for r in rows) == sorted(SEEN)
    assert all(r.bytes.decode() == r.uri.removeprefix(f"{tree}/") for r in rows)


def test_empty_folder_and_slash(spark, tree):
    (tree / "nothing").mkdir()
    assert _read(spark, tree / "nothing").count() == 0
    assert _read(spark, f"{tree}/").count() == len(SEEN)


def test_directories_have_one_owner(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"d{i}").mkdir()
        for j in range(3):
            (tmp_path / f"d{i}" / str(j)).write_text("x")
    rows = _read(spark, tmp_path, tasks=8, spreadDepth=1).select("uri", F.spark_partition_id().alias("p")).collect()
    owners = {}
    for r in rows:
        owners.setdefault(r.uri.rpartition("/")[0], set()).add(r.p)
    assert len(rows) == 120 and all(len(o) == 1 for o in owners.values()) and len({p for o in owners.values() for p in o}) > 4


class _Listing:
    """A file system that notes what is listed."""

    def __init__(self, fs):
        self.fs, self.listed = fs, []

    def get_file_info(self, selector):
        self.listed.append(selector.base_dir)
        return self.fs.get_file_info(selector)


def test_filters_prune_directories(spark, tree):
    fs, root = resolve(str(tree))
    noted = _Listing(fs)
    found = [e.path for e in custom._owned_files(noted, root, custom.FilesPartition(0, 1), 2, f"{root}/d/e/g")]
    assert sorted(found) == [f"{root}/d/e/g/h", f"{root}/d/e/g/i/j"]
    assert sorted(noted.listed) == [root, f"{root}/d", f"{root}/d/e", f"{root}/d/e/g", f"{root}/d/e/g/i"]


def test_pushed_filters_give_the_same_rows(spark, tree):
    uri, t = F.col("uri"), str(tree)
    filters = [
        uri == f"{t}/d/c", uri.isin(f"{t}/a", f"{t}/x/y/z/1", "/none"), uri.startswith(f"{t}/d/e"), uri.startswith(f"{t}/d/e/g") & uri.startswith(f"{t}/d"),
        uri.startswith(f"{t}/d") & uri.startswith(f"{t}/x"), uri.endswith("1") & (uri == f"{t}/x/y/z/1"), (uri == f"{t}/a") & (uri == f"{t}/b"),
        uri.isNull(), (uri == f"{t}/a") & uri.startswith(f"{t}/d"), uri.eqNullSafe(f"{t}/b"), uri.isin(f"{t}/a", None), uri != f"{t}/a",
    ]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = [sorted(r.uri for r in _read(spark, tree, pushFilters="true").where(f).collect()) for f in filters]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert pushed == [sorted(r.uri for r in _read(spark, tree).where(f).collect()) for f in filters]
    assert [len(p) for p in pushed] == [1, 2, 3, 2, 0, 1, 0, 0, 0, 1, 1, 8]


def test_stream_reads_new_files_once(spark, tree, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        files = spark.readStream.format("docspark_files").options(settleSeconds="0", tasks="3").load(str(tree))
        files.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r.uri.removeprefix(f"{tree}/") for r in spark.read.schema("uri string, bytes binary").parquet(out).collect())

    time.sleep(0.1)
    assert run() == sorted(SEEN)
    Path(tree, "x", "late").write_text("late")
    time.sleep(0.1)
    assert run() == sorted([*SEEN, "x/late"])
    assert run() == sorted([*SEEN, "x/late"])


def test_stream_offsets(tree):
    reader = custom.FilesStreamReader({"path": str(tree), "settleSeconds": "3600"})
    start, end = reader.initialOffset(), reader.latestOffset()
    assert [r for p in reader.partitions(start, end) for r in reader.read(p)] == []
    now = {"until": time.time_ns() + 10**9}
    assert len([r for p in reader.partitions(end, now) for r in reader.read(p)]) == len(SEEN)
    assert [r for p in reader.partitions(now, now) for r in reader.read(p)] == []


def test_local_directories_are_read_piece_by_piece(tree, monkeypatch):
    """A listing of a whole directory would be held by each task."""
    from pyarrow import fs as pafs

    def whole(*_):
        raise AssertionError("a whole directory was listed")

    fs, root = resolve(str(tree))
    want = sorted(e.path for e in custom._owned_files(_Listing(fs), root, custom.FilesPartition(0, 1), 2))
    monkeypatch.setattr(pafs, "FileSelector", whole)
    shares = [[e.path for e in custom._owned_files(fs, root, custom.FilesPartition(k, 3), 2)] for k in range(3)]
    assert sorted(p for s in shares for p in s) == want and want
    until = max(e.changed() for e in custom._owned_files(fs, root, custom.FilesPartition(0, 1), 2))
    assert list(custom._owned_files(fs, root, custom.FilesPartition(0, 1, until, until + 1), 2)) == []
