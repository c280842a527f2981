"""The document store: loads of Parquet files, of which the last row of each URI counts.

A store is a folder of loads, each written once and partitioned by a bucket of the URI hash. A small file,
``_loads-NNNNNN``, names those that count; the one with the highest number is the store's state, so that a load appears
at once or not at all, and a load that breaks leaves nothing behind that is read. Documents by reference are copied to
files below ``_blobs``. An upsert appends a load and reads
nothing; a scan drops the rows whose URI a later load has; ``compact_store`` makes one load of all.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.metadata import select_metadata
from docspark.operators.filters import filter_snapshot, filter_visible, scope
from docspark.operators.placement import bucket_by_uri
from docspark.runtime import BROADCAST_BYTES, BROADCAST_ROWS, by_key, is_small, materialize, maybe_broadcast, work_path
from docspark.schema import DOC_SCHEMA, METADATA_COLUMNS, to_docs
from docspark.sinks.hadoop import delete, full_path, has_files, names, read_text, size_of, write_new
from docspark.sources.io import AtomicFile
from docspark.sources.refs import WHOLE, chunks

# Bytes of documents per bucket, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 4 << 30, 8
STORE_SCHEMA = T.StructType(
    [
        *DOC_SCHEMA.fields,
        T.StructField("load", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
_HASHES = 4
#: Before the lines of a state file that name the batches which the store holds.
_APPLIED = "applied="
_OWN = ("load", "version", "buckets", "bucket")


def last_by_uri(df: DataFrame, order: Sequence[str] = ("src_id", "line")) -> DataFrame:
    """One row per URI, the last by (src_id, line); combined per task before the shuffle."""
    row = F.struct(*df.columns)
    tie = F.xxhash64(*[F.coalesce(c, F.lit("")) for c in ("text", "sub_id")])
    return df.groupBy(F.col("uri").alias("_key")).agg(F.max_by(row, F.struct(*order, tie)).alias("_d")).select("_d.*")


def prepare_target(spark: SparkSession, path: str, mode: str = "fail") -> None:
    """Before a load: ``clean`` empties the target, ``fail`` refuses one that has documents."""
    if mode == "clean":
        delete(spark, path)
    elif mode == "fail":
        if has_files(spark, path):
            raise FileExistsError(f"the target holds files: {path}")
    else:
        raise ValueError(f"unknown mode {mode}")


def _state(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """(number of the newest state, folders of the loads that count, in order)."""
    states = sorted(n for n in names(spark, path) if n.startswith("_loads-") and n[7:].isdigit())
    if not states:
        return -1, []
    lines = read_text(spark, f"{path}/{states[-1]}").split()
    return int(states[-1][7:]), [line for line in lines if not line.startswith(_APPLIED)]


def _job_key(job: str) -> str:
    return hashlib.md5(job.encode()).hexdigest()


def _applied(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each job that the store holds, by the job's key."""
    number = _state(spark, path)[0]
    if number < 0:
        return {}
    lines = read_text(spark, f"{path}/_loads-{number:06d}").split()
    return {key: int(batch) for line in lines if line.startswith(_APPLIED) for key, batch in [line[len(_APPLIED) :].split(":")]}


def is_applied(spark: SparkSession, path: str, load_id: tuple[str, int]) -> bool:
    """Whether the store holds this batch of the job, or a later one."""
    return _applied(spark, path).get(_job_key(load_id[0]), -1) >= load_id[1]


def own_blobs(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with referenced documents copied to files of the store, so that it does not depend on their sources; rows
    whose source is not there or is damaged, with a ``skip_reason``). Other faults of a file system fail the task, which is
    run again."""
    if rows.where("ref is not null").isEmpty():
        return rows, rows.where("false")
    root = full_path(rows.sparkSession, path)
    fields = rows.schema
    keep = "skip_reason" in rows.columns
    schema = fields if keep else T.StructType([*fields, T.StructField("skip_reason", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, reasons = [], []
            for src_id, ref in zip(batch["src_id"], batch["ref"], strict=True):
                # named by where the bytes come from: a repeated task writes the same file
                name = hashlib.md5(f"{src_id}\n{ref}\n{stamp}".encode()).hexdigest()
                file = AtomicFile(f"{root}/_blobs/{name}", str(TaskContext.get().taskAttemptId()))
                try:
                    for chunk in chunks(src_id, ref):
                        file.stream.write(chunk)
                except (FileNotFoundError, EOFError, ValueError, zlib.error, gzip.BadGzipFile) as e:
                    file.discard()
                    places.append(src_id)
                    reasons.append(f"not stored: {type(e).__name__}: {e}")
                    continue
                file.close()
                places.append(f"{root}/_blobs/{name}")
                reasons.append(None)
            yield batch.assign(src_id=places, ref=[WHOLE if r is None else ref for r, ref in zip(reasons, batch["ref"], strict=True)], skip_reason=reasons)

    stamp = uuid.uuid4().hex
    moved = materialize(rows.where("ref is not null").mapInPandas(run, schema), "blobs")
    stored = moved.where("skip_reason is null").select(*rows.columns)
    return rows.where("ref is null").unionByName(stored), moved.where("skip_reason is not null")


def _append(
    spark: SparkSession, rows: DataFrame, path: str, buckets: int, after: tuple[int, list[str]], keep: bool,
    load_id: tuple[str, int] | None = None, fresh: bool = False,
) -> None:
    """Write a load and make it count, after those there (``keep``) or in their place; a ``fresh`` store forgets the batches
    that it held."""
    number, loads = after
    applied = {} if fresh else _applied(spark, path)
    if load_id is not None:
        applied[_job_key(load_id[0])] = load_id[1]
    folder = f"version={number + 1:06d}-{uuid.uuid4().hex}"
    rows = rows.drop(*_OWN).withColumn("load", F.lit(number + 1).cast("long")).withColumn("buckets", F.lit(buckets))
    rows = rows.withColumn("bucket", bucket_by_uri(F.col("uri"), buckets)).hint("rebalance", F.col("bucket"))
    rows.write.partitionBy("buckets", "bucket").parquet(f"{path}/{folder}")
    write_new(spark, f"{path}/_loads-{number + 1:06d}", "\n".join([*(loads if keep else []), folder, *[f"{_APPLIED}{k}:{n}" for k, n in applied.items()]]))
    if keep:
        return
    # nothing names the old loads any more
    for name in names(spark, path):
        if name not in (folder, f"_loads-{number + 1:06d}", "_blobs"):
            delete(spark, f"{path}/{name}")


def _read(spark: SparkSession, path: str, loads: list[str]) -> DataFrame:
    if not loads:
        raise FileNotFoundError(f"no store at {path}")
    return spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*[f"{path}/{name}" for name in loads])


def _marks(uris: DataFrame, bits: int) -> DataFrame:
    """A Bloom filter of the URIs of each bucket: (buckets, bucket, words), ``bits`` bits in 64-bit words."""
    at = uris.select("buckets", "bucket", F.explode(F.array(*_bits(bits))).alias("at"))
    one = at.select("buckets", "bucket", F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    words = one.groupBy("buckets", "bucket", "word").agg(F.bit_or("bit").alias("bit"))

    def dense(key: tuple, table: pa.Table) -> pa.Table:
        filled = np.zeros(bits // 64, np.int64)
        filled[table.column("word").to_numpy()] = table.column("bit").to_numpy()
        return pa.table({"buckets": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int32()), "words": pa.array([filled], pa.list_(pa.int64()))})

    return words.groupBy("buckets", "bucket").applyInArrow(dense, "buckets int, bucket int, words array<bigint>")


def _bits(bits: int) -> list[Column]:
    """The places of a URI in a filter of a power of two of bits."""
    # numbers of 32 bits, so that their sums do not overflow
    one, step = (F.xxhash64("uri", F.lit(seed)).bitwiseAND(F.lit(0xFFFFFFFF)) for seed in range(2))
    step = step.bitwiseOR(F.lit(1))
    return [(one + F.lit(k) * step).bitwiseAND(F.lit(bits - 1)) for k in range(_HASHES)]


def _marked(bits: int) -> Column:
    """Whether ``words`` may hold the URI."""
    found = F.lit(True)
    for at in _bits(bits):
        word = F.get("words", F.shiftright(at, 6).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
        found = found & (word.bitwiseAND(mask) != 0)
    return F.coalesce(found, F.lit(False))


def _filter_bits(n: int, buckets: int) -> int:
    """Bits for each bucket: sixteen for a URI, while all filters together may be sent to the tasks."""
    wanted, most = max(64, 16 * -(-n // buckets)), max(64, 8 * BROADCAST_BYTES // buckets)
    return 1 << min((wanted - 1).bit_length(), most.bit_length() - 1)


def _unreplaced(rows: DataFrame, later: DataFrame, last: DataFrame, bits: int) -> DataFrame:
    """Rows without a newer one. Those whose URI no later load can hold, by its bucket's filter, are not shuffled."""
    marks = F.broadcast(materialize(_marks(later.select("buckets", "bucket", "uri"), bits), "key-filters"))
    tested = rows.join(marks, ["buckets", "bucket"], "left")
    maybe = _marked(bits)
    columns = rows.columns
    newer = (F.col("uri") == F.col("_uri")) & (F.col("load") < F.col("_last"))
    doubtful = tested.where(maybe).select(*columns).join(by_key(last), newer, "left_anti")
    return tested.where(~maybe).select(*columns).unionByName(doubtful)


def _latest(spark: SparkSession, path: str, as_of: int | None = None, few: int = BROADCAST_ROWS) -> DataFrame:
    """The last row of each URI, of those created up to ``as_of``.

    URIs of later loads are sent to the tasks if there are at most ``few``. Else filters of them are, of bounded size, and
    only documents that these do not rule out are shuffled: about as many as the later loads have.
    """
    loads = _state(spark, path)[1]
    rows = _read(spark, path, loads)
    if len(loads) < 2:
        return rows
    later = _read(spark, path, loads[1:])
    if as_of is not None:
        later = later.where(F.col("created_ts") <= as_of)
    last = later.groupBy(F.col("uri").alias("_uri")).agg(F.max("load").alias("_last"))
    newer = (F.col("uri") == F.col("_uri")) & (F.col("load") < F.col("_last"))
    if is_small(last, few):
        return rows.join(F.broadcast(last), newer, "left_anti")
    n, buckets = later.agg(F.count(F.lit(1)), F.max("buckets")).first()
    return _unreplaced(rows, later, last, _filter_bits(n, buckets))


def store_buckets(spark: SparkSession, path: str) -> int:
    """Number of buckets of a store's loads."""
    return _read(spark, path, _state(spark, path)[1][:1]).select("buckets").first().buckets


def _staged(docs: DataFrame, name: str = "load") -> tuple[DataFrame, int]:
    """(the documents as a written table, their bytes)."""
    path = work_path(docs.sparkSession, name)
    docs.write.parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path), size_of(docs.sparkSession, path)


def _buckets_for(size: int) -> int:
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def _one_per_uri(staged: DataFrame) -> DataFrame:
    """The last document of each URI. Only URIs that really repeat are shuffled with their content."""
    repeated = staged.groupBy("uri").count().where("count > 1").select("uri")
    if repeated.isEmpty():
        return staged
    repeated = maybe_broadcast(materialize(repeated, "repeated"))
    once = staged.join(repeated, "uri", "left_anti")
    return once.unionByName(last_by_uri(staged.join(repeated, "uri", "left_semi")))


def write_store(docs: DataFrame, path: str, buckets: int | None = None, mode: str = "fail") -> None:
    """New store. Rejected records must be split off before; of several documents with one URI the last stays.

    ``fail`` refuses a target that has documents; ``clean`` replaces them, once the new ones are written. Without
    ``buckets`` their number follows the volume.
    """
    spark = docs.sparkSession
    if mode != "clean":
        prepare_target(spark, path, mode)
    rows, size = _staged(to_docs(docs))
    _append(spark, _all_own(_one_per_uri(rows), path), path, buckets or _buckets_for(size), _state(spark, path), keep=False, fresh=True)


def _all_own(rows: DataFrame, path: str) -> DataFrame:
    """``own_blobs`` where it is an error if a document cannot be read."""
    rows, refused = own_blobs(rows, path)
    lost = refused.first()
    if lost is not None:
        raise OSError(f"{lost.uri}: {lost.skip_reason}")
    return rows


def upsert_docs(
    docs: DataFrame, path: str, buckets: int | None = None, staged: bool = False, load_id: tuple[str, int] | None = None, owned: bool = False
) -> None:
    """Insert or replace documents by URI: what is written follows the load, not the store.

    ``staged`` says that ``docs`` is a written table already. Older versions stay until the store is compacted, and
    are what ``scan_docs(as_of=)`` reads. One writer at a time. ``load_id`` (job, number of the batch) becomes part of the
    store's state with the load: a batch that the store holds already is not written again. ``owned``: referenced documents
    went through ``own_blobs``.
    """
    spark = docs.sparkSession
    if load_id is not None and is_applied(spark, path, load_id):
        return
    docs, size = (to_docs(docs), 0) if staged else _staged(to_docs(docs))
    if docs.isEmpty():
        return
    state = _state(spark, path)
    number = store_buckets(spark, path) if state[1] else buckets or _buckets_for(size)
    rows = _one_per_uri(docs)
    _append(spark, rows if owned else _all_own(rows, path), path, number, state, keep=True, load_id=load_id)


def compact_store(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """One load of the last row of each URI; older versions go. Readers that began before must have ended."""
    state = _state(spark, path)
    rows, size = _staged(_latest(spark, path).drop(*_OWN), "compacted")
    _append(spark, _all_own(rows, path), path, buckets or _buckets_for(size), state, keep=False)


def scan_docs(
    spark: SparkSession,
    path: str,
    collections: list[str] | None = None,
    directories: list[str] | None = None,
    selector: str | None = None,
    query: Column | None = None,
    types: list[str] | None = None,
    as_of: int | None = None,
    copy_collections: bool = True,
    copy_permissions: bool = True,
    copy_properties: bool = True,
    copy_quality: bool = True,
    copy_metadata: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Stored documents under a scope, with the wanted metadata. URI, type and stamp predicates reach the scan.

    Without ``as_of`` live documents are read, with it those that lived at that stamp. ``broadcast_rows``: how many URIs of
    later loads may be sent to the tasks as they are.
    """
    docs = _latest(spark, path, as_of, broadcast_rows).drop(*_OWN)
    docs = filter_visible(docs) if as_of is None else filter_snapshot(docs, as_of)
    docs = docs.where(scope(collections, directories, selector, query, types))
    return select_metadata(docs, copy_collections, copy_permissions, copy_properties, copy_quality, copy_metadata)


def full_metadata(docs: DataFrame) -> DataFrame:
    """Back to the full schema, switched-off metadata at its defaults."""
    missing = [c for c in METADATA_COLUMNS if c not in docs.columns]
    return to_docs(docs) if missing else docs


def write_partition(docs: DataFrame, path: str, partition: str) -> None:
    """Replace one named partition of a target; the others stay."""
    docs.withColumn("target_partition", F.lit(partition)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("target_partition").parquet(path)
