"""Files below given paths, listed, dealt and read by tasks.

Spark's own scan of files keeps an object per file on the driver, whatever the size of the files. Here tasks walk the folders and
write down what they find; the driver sees sums per task only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.runtime import materialize, ship
from docspark.sinks.hadoop import matches
from docspark.sources.io import entries, resolve

TASK_BYTES = 128 << 20
FILE_COST = 4096  # what opening a file counts beside its bytes
LEAST_BYTES = 64 * FILE_COST  # a task of less is not worth its start
BATCH_BYTES, BATCH_ROWS = 16 << 20, 10_000
#: Entries that a task of the first round sees before it leaves further folders to others.
ENOUGH = 50_000

_LISTED = pa.schema([("part", pa.int64()), ("path", pa.string()), ("length", pa.int64()), ("at", pa.int64())])
_READ = pa.schema([("path", pa.string()), ("content", pa.binary())])


def hidden(name: str, is_dir: bool) -> bool:
    """Names that Spark's scans leave out, also those that are no text."""
    if name.encode(errors="ignore").decode() != name:
        return True
    if is_dir and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _below(path: str, folder: str) -> list[str] | None:
    """Names from ``folder`` down to ``path``, if it lies below."""
    start = folder.rstrip("/") + "/"
    return path[len(start) :].split("/") if path.startswith(start) else None


def _roots(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """What the paths name, each once, without what another one's walk finds; nothing if one of the paths names nothing."""
    named = [matches(spark, path) for path in paths]
    if not all(named):
        return []
    found = dict.fromkeys(p for some in named for p in some)

    def walked(path: str) -> bool:
        folder = path
        while "/" in folder.rstrip("/"):
            folder = folder.rstrip("/").rpartition("/")[0]
            top = next((f for f in (folder, folder + "/") if f in found), None)
            if top is not None and not any(hidden(n, True) for n in _below(path, top)):
                return True
        return False

    return [p for p in found if not walked(p)]


def _walk(tops: Iterator[str], enough: int) -> Iterator[tuple[str, int | None]]:
    """(path, bytes) of the files below folders; folders that were not entered, as enough was seen, have null bytes. Empty files
    are left out, as by Spark's scans, and so is what is gone since."""
    seen = 0
    for top in tops:
        fs, at = resolve(top)
        info = fs.get_file_info([at])[0]
        if info.is_file:
            if info.size and not hidden(top.rpartition("/")[2], False):
                yield top, info.size
            continue
        pending = [top]
        while pending:
            folder = pending.pop()
            if seen >= enough:
                yield folder, None
                continue
            fs, at = resolve(folder)
            try:
                for e in entries(fs, at):
                    seen += 1
                    if hidden(e.name, e.is_dir):
                        continue
                    path = f"{folder.rstrip('/')}/{e.name}"
                    if e.is_dir and seen < enough:
                        pending.append(path)
                    elif e.is_dir:
                        yield path, None
                    elif size := _size(e):
                        yield path, size
            except FileNotFoundError:
                continue


def _size(e) -> int:
    try:
        return e.size()
    except FileNotFoundError:  # a link to nothing, say
        return 0


def _lister(turn: int):
    """Lists folders; ``at`` is the cost of the files that the task has found before, ``part`` the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, rows = (turn << 32) + TaskContext.get().partitionId(), 0, []
        for path, length in _walk((p for b in batches for p in b.column(0).to_pylist()), ENOUGH << turn):
            rows.append((part, path, length, at))
            at += 0 if length is None else min(length, TASK_BYTES) + FILE_COST
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows, _LISTED)
                rows = []
        if rows:
            yield _batch(rows, _LISTED)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _opens(path: str) -> bool:
    """Whether tasks can open a path without Spark."""
    try:
        fs, at = resolve(path)
        return fs.get_file_info([at])[0].type != pafs.FileType.NotFound
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def list_below(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """(path, length) of the files below ``paths``, dealt to tasks by volume, in runs of neighbours; none if a path does not exist
    or only Spark opens it.

    Tasks walk the folders, in rounds: one that has seen enough leaves the rest to all. A folder is listed by one task.
    """
    roots = _roots(spark, paths)
    stores = {re.match(r"[^:/]*:(?://[^/]*)?", r)[0]: r for r in roots}
    if not roots or not all(map(_opens, stores.values())):
        return None
    ship(spark)
    cores = spark.sparkContext.defaultParallelism
    folders, found, sums, turn = spark.createDataFrame([(r,) for r in roots], "path string"), None, [], 0
    while folders is not None:
        listed = materialize(folders.mapInArrow(_lister(turn), "part bigint, path string, length bigint, at bigint"), "listing")
        cost = F.sum(F.least("length", F.lit(TASK_BYTES)) + FILE_COST)
        sums += (new := listed.groupBy("part").agg(F.count_if(F.col("length").isNull()), F.coalesce(cost, F.lit(0))).collect())
        left, turn = sum(n for _, n, _ in new), turn + 1
        found = listed if found is None else found.unionByName(listed)
        folders = listed.where("length is null").select("path").repartition(min(left, 4 * cores)) if left else None
    files = found.where("length is not null")
    total = sum(c for _, _, c in sums)
    share = max(LEAST_BYTES, min(TASK_BYTES, -(-total // (8 * cores))))
    tasks = -(-total // share)
    if tasks <= 1:
        return files.select("path", "length").coalesce(1)
    starts, start = [], 0
    for part, _, c in sums:
        starts.append((part, start))
        start += c
    placed = files.join(F.broadcast(spark.createDataFrame(starts, "part bigint, start bigint")), "part")
    task = F.floor((F.col("start") + F.col("at")) / share).cast("int")
    return placed.repartitionById(tasks, task).select("path", "length")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size, opened, fs, at = [], 0, None, None, None
    for batch in batches:
        for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if rows and (size + length > BATCH_BYTES or len(rows) >= BATCH_ROWS):
                yield _batch(rows, _READ)
                rows, size = [], 0
            folder, _, name = path.rpartition("/")
            if folder != opened:
                (fs, at), opened = resolve(folder + "/"), folder
            with fs.open_input_stream(f"{at.rstrip('/')}/{name}", compression=None) as f:
                rows.append((path, f.read()))
            size += length
    if rows:
        yield _batch(rows, _READ)


def with_content(files: DataFrame) -> DataFrame:
    """(path, content) of listed files (path, length)."""
    return files.select("path", "length").mapInArrow(_read, "path string, content binary")
