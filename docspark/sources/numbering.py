"""Numbering records in file order, without moving them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docspark.runtime import ship


class _Splits:
    """Running sums inside each file split of a task, carried from batch to batch."""

    def __init__(self, path: str, start: str):
        self.keys, self.last, self.carried = (path, start), None, {}

    def enter(self, b: pa.RecordBatch) -> None:
        """Find where splits begin in the next batch."""
        paths, starts = b.column(self.keys[0]).dictionary_encode(), np.asarray(b.column(self.keys[1]))
        codes = np.asarray(paths.indices)
        self.new = np.zeros(b.num_rows, dtype=bool)
        self.new[1:] = (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])
        self.new[0] = (paths.dictionary[int(codes[0])].as_py(), int(starts[0])) != self.last
        self.last = (paths.dictionary[int(codes[-1])].as_py(), int(starts[-1]))

    def running(self, name: str, step: np.ndarray) -> np.ndarray:
        """Sum of ``step`` up to and with each row of its split."""
        total = np.cumsum(step)
        # what was counted before the split of a row began; a split continued from the last batch adds its carry
        base = np.maximum.accumulate(np.where(self.new, total - step, -1))
        out = np.where(base >= 0, total - base, total + self.carried.get(name, 0))
        self.carried[name] = int(out[-1])
        return out


def _with_columns(b: pa.RecordBatch, **added: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(a.astype("int64")) for a in added.values()]
    return pa.RecordBatch.from_arrays([*b.columns, *arrays], names=[*b.schema.names, *added])


def _schema(df: DataFrame, *names: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, T.LongType()) for n in names]])


def number_in_split(
    df: DataFrame, keys: tuple[str, str] = ("src_id", "block"), name: str = "n", counted: str | None = None
) -> DataFrame:
    """Add the 1-based number of each row inside its file split, counting only rows where ``counted`` holds.

    A file split is read by one task, in order, so a running counter per task is exact and needs no shuffle.
    Must be applied before any exchange.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _Splits(*keys)
        for b in batches:
            if b.num_rows:
                splits.enter(b)
                step = np.asarray(b.column(counted)).astype("int64") if counted else np.ones(b.num_rows, "int64")
                yield _with_columns(b, **{name: splits.running(name, step)})

    return df.mapInArrow(run, _schema(df, name))


def first_in_split(df: DataFrame, where: str, keys: tuple[str, str] = ("src_id", "block"), name: str = "n") -> DataFrame:
    """Of each file split the first row where ``where`` holds, with its number as by :func:`number_in_split`.

    Must be applied before any exchange.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _Splits(*keys)
        for b in batches:
            if b.num_rows:
                splits.enter(b)
                holds = np.asarray(b.column(where)).astype("int64")
                n, found = splits.running(name, np.ones(b.num_rows, "int64")), splits.running(where, holds)
                first = (holds == 1) & (found == 1)
                if first.any():
                    yield _with_columns(b, **{name: n}).filter(pa.array(first))

    return df.mapInArrow(run, _schema(df, name))


def mark_quotes(df: DataFrame, quotes: str = "quotes") -> DataFrame:
    """Add to lines (src_id, block, quotes) the quotes before each line of its split, and the number of record
    starts up to it if the split begins outside (``rec0``) or inside (``rec1``) a quoted field."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _Splits("src_id", "block")
        for b in batches:
            if b.num_rows:
                splits.enter(b)
                step = np.asarray(b.column(quotes)).astype("int64")
                before = splits.running("quotes", step) - step
                outside = (before % 2 == 0).astype("int64")
                rec0, rec1 = splits.running("rec0", outside), splits.running("rec1", 1 - outside)
                yield _with_columns(b, before=before, rec0=rec0, rec1=rec1)

    return df.mapInArrow(run, _schema(df, "before", "rec0", "rec1"))
