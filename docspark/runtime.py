"""Shared folder, written intermediate tables and distributed row positions."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docspark.sinks.hadoop import full_path

# Lookups are sent to every task only below this size; larger ones are joined by key.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

_local_dir: str | None = None
#: Tables that ``materialize`` wrote, in order.
written: list[str] = []
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        # tasks open files without Spark: a path on another than the local file system must say so
        full = full_path(spark, named)
        return (named if full.startswith("file:") else full).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="docspark-")
    return _local_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, unique per call."""
    return f"{shared_dir(spark)}/docspark/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the tasks this package, as ``--py-files`` would; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    from docspark.sources.io import resolve

    package = Path(__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, f"{package.name}/{source.relative_to(package)}")
    target = f"{work_path(spark, 'lib')}/{package.name}.zip"
    fs, path = resolve(target)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(packed.getvalue())
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a table of a few row groups over the cores before work that is heavy per row.

    A scan never cuts a row group, so a small table would keep one core busy. A table with as many
    partitions as cores, as any large one has, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= cores else df.repartition(cores)


def pack_small_files(df: DataFrame) -> DataFrame:
    """A scan of whole files in tasks that are worth their start.

    Spark counts each file as 4 MB at least and so gives a task about thirty small ones; up to thirty-two of such tasks become one,
    without a shuffle, while eight are left for each core. A task still holds one file at a time.
    """
    found, cores = df._jdf.rdd().getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    tasks = max(8 * cores, -(-found // 32))
    return df.coalesce(tasks) if found > tasks else df


def spread_by_key(df: DataFrame, key: str) -> DataFrame:
    """Spread rows for work of a user's own per row, of which a table's bytes say nothing: rows of one key go to one task, in order."""
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, key)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, str]:
    """``df``, written, with a number for each row, and the name of that column, which ``df`` does not have."""
    key, taken = "_row", {c.lower() for c in df.columns}
    while key in taken:
        key = "_" + key
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), name), key


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be sent to every task. Reads at most ``max_rows + 1`` rows."""
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, used = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and used <= max_bytes


def by_key(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled by key. The optimizer takes sizes from compressed files and from the share of
    their columns, and does not see what an explode makes: it would send large tables through the driver to every task."""
    return df.hint("merge")


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when ``df`` really is small; otherwise the join is shuffled by key."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else by_key(df)


def split_partition(col: Column) -> Column:
    """Partition number inside a ``monotonically_increasing_id`` value."""
    return F.shiftright(col, 33)


def with_positions(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "pos", weight: str | None = None
) -> DataFrame:
    """Add the 1-based position of each row by ``order`` inside ``group`` as BIGINT column ``name``.

    With ``weight`` a row takes that many positions and ``name`` is its first one.

    A window over one group would put the whole group in one task. Here the rows are range-sorted by
    (group, order) and written once; each partition then only needs the number of rows of its group in
    earlier partitions, a table with one row per (partition, group). A hot group spreads over many
    partitions. ``order`` should be unique inside a group, else ties rank in an unspecified order.
    """
    group = list(group)
    ranged = materialize(
        df.sort(*group, *order).withColumn("_id", F.monotonically_increasing_id()), "positions"
    ).withColumn("_part", split_partition(F.col("_id")))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.count(F.lit(1)) if weight is None else F.sum(weight)
    starts = (
        ranged.groupBy(*group, "_part")
        .agg(taken.alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    if weight is None:
        local = F.col("l._id") - F.col("r._first")
    else:
        # a running sum inside one partition of the sorted table, which is bounded
        inside = Window.partitionBy(*group, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
        ranged = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        local = F.col("l._local")
    cond = F.col("l._part") == F.col("r._part")
    for g in group:
        cond = cond & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    # without groups there is one row per partition; with groups the size is checked first
    starts = maybe_broadcast(starts) if group else F.broadcast(starts)
    joined = ranged.alias("l").join(starts.alias("r"), cond, "inner")
    pos = local + F.col("r._before") + 1
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], pos.cast("bigint").alias(name))
