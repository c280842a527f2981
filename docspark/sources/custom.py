"""User-defined sources and sinks: a Python data source that reads and writes files, as a template."""

from __future__ import annotations

import os
import time
import zlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from docspark.runtime import ship
from docspark.sources.io import Entry, entries


class FilesPartition(InputPartition):
    """The files that task ``number`` of ``tasks`` owns, changed after ``since`` and up to ``until`` (nanoseconds)."""

    def __init__(self, number: int, tasks: int, since: int | None = None, until: int | None = None):
        self.number, self.tasks, self.since, self.until = number, tasks, since, until


def _owned_files(fs, root: str, part: FilesPartition, depth: int, prefix: str = "") -> Iterator[Entry]:
    """The files below ``root`` that a task owns, found by walking directories in the task.

    All tasks walk the first ``depth`` levels and share the files there by a hash of their path; directories at that depth
    belong to one task each, with all below. Only directories that can hold paths with ``prefix`` are listed.
    """

    def mine(path: str) -> bool:
        return zlib.crc32(path.encode()) % part.tasks == part.number

    depth = max(depth, 1)
    folders = [(root, 0)]
    while folders:
        folder, level = folders.pop()
        for entry in entries(fs, folder):
            if entry.name.startswith(("_", ".")):
                continue
            if entry.is_dir:
                inner = entry.path + "/"
                if (inner.startswith(prefix) or prefix.startswith(inner)) and (level + 1 != depth or mine(entry.path)):
                    folders.append((entry.path, level + 1))
            elif entry.path.startswith(prefix) and (level >= depth or mine(entry.path)):
                if part.since is None or part.since < entry.changed() <= part.until:
                    yield entry


class FilesReader(DataSourceReader):
    """Files are listed and opened in the tasks. ``tasks`` (16) should be the cores of the cluster or more, ``spreadDepth`` (2)
    is the level of directories that belong to one task each, 1 at least.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.tasks, self.depth = int(options.get("tasks", "16")), int(options.get("spreadDepth", "2"))
        self.prefix, self.wanted = "", None

    def partitions(self) -> list[FilesPartition]:
        return [FilesPartition(i, self.tasks) for i in range(self.tasks)]

    def read(self, partition: FilesPartition) -> Iterator[tuple]:
        from docspark.sources.io import resolve

        fs, root = resolve(self.path)
        prefix = self.prefix
        if self.wanted is not None:
            prefix = max(prefix, os.path.commonprefix([w for w in self.wanted if w is not None]), key=len)
        for entry in _owned_files(fs, root.rstrip("/"), partition, self.depth, prefix):
            if (self.wanted is None or entry.path in self.wanted) and entry.path.startswith(self.prefix):
                with fs.open_input_file(entry.path) as f:
                    yield entry.path, bytes(f.read())


class FilteredFilesReader(FilesReader):
    """Conditions ``uri = ...``, ``uri in (...)`` and ``startswith`` on it decide which directories are listed and which files
    are opened. For option ``pushFilters``; Spark refuses it unless ``spark.sql.python.filterPushdown.enabled`` is set."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("uri",):
                # of two prefixes the longer one, if it begins with the other
                longer, shorter = (f.value, self.prefix) if len(f.value) > len(self.prefix) else (self.prefix, f.value)
                if longer.startswith(shorter):
                    self.prefix = longer
                    continue
            elif isinstance(f, EqualTo | In) and f.attribute == ("uri",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = named if self.wanted is None else self.wanted & named
                continue
            yield f


class FilesStreamReader(DataSourceStreamReader):
    """New and changed files by their time: an offset is the time up to which files were read, so nothing is listed on the
    driver and nothing is remembered per file. A batch that is run again reads the same files, unless they changed.

    ``settleSeconds`` (10) is how long after its time a file must be visible, for clocks that differ and slow renames; files that
    appear with an older time are not seen.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.tasks, self.depth = int(options.get("tasks", "16")), int(options.get("spreadDepth", "2"))
        self.settle = int(float(options.get("settleSeconds", "10")) * 1_000_000_000)

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() - self.settle}

    def partitions(self, start: dict, end: dict) -> list[FilesPartition]:
        return [FilesPartition(i, self.tasks, start["until"], end["until"]) for i in range(self.tasks)]

    def read(self, partition: FilesPartition) -> Iterator[tuple]:
        from docspark.sources.io import resolve

        fs, root = resolve(self.path)
        for entry in _owned_files(fs, root.rstrip("/"), partition, self.depth):
            with fs.open_input_file(entry.path) as f:
                yield entry.path, bytes(f.read())


class Written(WriterCommitMessage):
    def __init__(self, files: int):
        self.files = files


class FilesWriter(DataSourceWriter):
    """One file per row, at the URI below the path; a repeated task puts the same files in place again."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        from docspark.sources.io import AtomicFile

        attempt, n = str(TaskContext.get().taskAttemptId()), 0
        for row in rows:
            if ".." in row.uri.split("/"):
                raise ValueError(f"path leaves the output directory: {row.uri}")
            f = AtomicFile(f"{self.path}/{row.uri.lstrip('/')}", attempt)
            f.stream.write(bytes(row.bytes))
            f.close()
            n += 1
        return Written(n)


class FilesSource(DataSource):
    """``spark.read.format("docspark_files").load(path)``: (uri, bytes); the same columns can be saved."""

    @classmethod
    def name(cls) -> str:
        return "docspark_files"

    def schema(self) -> str:
        return "uri string, bytes binary"

    def reader(self, schema) -> FilesReader:
        return (FilteredFilesReader if self.options.get("pushFilters", "").lower() == "true" else FilesReader)(self.options)

    def streamReader(self, schema) -> FilesStreamReader:
        return FilesStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(FilesSource)
