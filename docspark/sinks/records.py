"""SequenceFiles, reject tables and user sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from docspark.operators.filters import reject_split
from docspark.runtime import materialize, ship, spread_by_key


def write_sequencefile(docs: DataFrame, path: str, value_type: str = "TEXT") -> None:
    """(URI, text) or (URI, bytes) pairs."""
    column = {"TEXT": "text", "BYTES": "bytes"}[value_type.upper()]
    rows = docs.where(F.col(column).isNotNull()).select("uri", column).rdd
    if column == "text":
        rows.map(tuple).saveAsSequenceFile(path)
    else:
        rows.map(lambda r: (r[0], bytearray(r[1]))).saveAsSequenceFile(path)


def write_rejects(docs: DataFrame, path: str) -> DataFrame:
    """Write rejected records with source, line and reason; returns the documents that go on."""
    kept, rejected = reject_split(docs)
    rejected.write.mode("append").parquet(path)
    return kept


def foreach_kv(pairs: DataFrame, fn: Callable[[object, object], None], setup: Callable[[], Callable] | None = None) -> None:
    """Run a user statement per (key, value), in the tasks. ``setup`` makes one ``fn`` per task, to hold a
    connection, say. Pairs are spread over the tasks by key, and those of one key go to one task. A repeated task repeats its
    calls, so ``fn`` should be idempotent."""

    def run(rows: Iterator) -> None:
        call = setup() if setup is not None else fn
        for key, value in rows:
            call(key, value)

    spread_by_key(pairs.select("key", "value"), "key").foreachPartition(run)


def foreach_reported(docs: DataFrame, fn: Callable[[object], None], setup: Callable[[], Callable] | None = None) -> DataFrame:
    """Run a user statement per document, in the tasks; returns (uri, skip_reason) of those on which it raised.

    The report is written down as the statements run, so that reading it does not run them again. ``setup`` makes one ``fn`` per
    task. A repeated task repeats its calls, so ``fn`` should be idempotent.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = setup() if setup is not None else fn
        for batch in batches:
            refused = []
            for row in batch.to_pylist():
                try:
                    call(Row(**row))
                except Exception as e:  # whatever a user's statement raises is its answer
                    refused.append((row["uri"], f"{type(e).__name__}: {e}"))
            uris, reasons = zip(*refused, strict=True) if refused else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(uris, pa.string()), pa.array(reasons, pa.string())], names=["uri", "skip_reason"])

    return materialize(docs.mapInArrow(run, "uri string, skip_reason string"), "refused")
