"""Exact integer k-means over dictionary-encoded subvectors.

How it runs:

1. vectors become integers; a task gathers up to ``CHUNK`` of them, and each block of ``WIDTH`` dimensions of the chunk becomes
   a dictionary of its distinct subvectors and a code per vector. Nothing is lost, and no row is shuffled. A dictionary holds
   at most ``CHUNK`` subvectors, whatever the table's size, and copies of a vector share all their codes;
2. a round computes the exact squared distance of each dictionary entry to each centroid once, and adds, for every vector,
   the distances that its codes name. A chunk sends on counts and sums only, made from how often a cluster uses a code;
3. the new centroids, 8 rows, go through the driver to the next round, which reads the encoded table again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import narrowed
from docspark.runtime import materialize

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
#: Dimensions per block, and vectors per chunk.
WIDTH = 2
CHUNK = 1 << 16
#: Largest size of an integer component: squared distances of 64 of them fit into 64 bits.
LARGEST = 1 << 27

_ENCODED = "ids array<bigint>, n long, codes binary, entries binary, sizes array<int>"


def kept(column: str = "embedding", dims: int = DIMS):
    """Whether a vector has exactly ``dims`` components, none of them null or non-finite."""
    v = F.col(column)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) == dims) & ~F.coalesce(odd, F.lit(False))


def integers(flat: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """floor(1024 * x) of each component, a row per vector."""
    values = np.floor(flat.reshape(-1, dims) * SCALE)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // SCALE}: squared distances would not fit into 64 bits")
    return values.astype(np.int64)


def encode(vectors: np.ndarray, width: int = WIDTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(distinct subvectors, code of each vector) per block of ``width`` dimensions; the last block may be narrower."""
    entries, codes = [], []
    for lo in range(0, vectors.shape[1], width):
        part = np.ascontiguousarray(vectors[:, lo : lo + width])
        rows = part.view([("", part.dtype)] * part.shape[1]).ravel()
        found, code = np.unique(rows, return_inverse=True)
        entries.append(found.view(part.dtype).reshape(-1, part.shape[1]))
        codes.append(code.ravel())
    return entries, codes


def decode(entries: list[np.ndarray], codes: list[np.ndarray]) -> np.ndarray:
    """The vectors that were encoded."""
    return np.concatenate([e[c] for e, c in zip(entries, codes, strict=True)], axis=1)


def nearest(entries: list[np.ndarray], codes: list[np.ndarray], centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of each vector; ties go to the smaller number."""
    total, lo = np.zeros((n, len(centroids)), np.int64), 0
    for e, c in zip(entries, codes, strict=True):
        part = centroids[:, lo : lo + e.shape[1]]
        # once per entry, however many vectors use it
        away = ((e[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)
        total += away[c]
        lo += e.shape[1]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster]


def sums(entries: list[np.ndarray], codes: list[np.ndarray], cluster: np.ndarray, k: int) -> np.ndarray:
    """Sum of the vectors of each cluster: how often it uses a code, times the code's entry."""
    parts = []
    for e, c in zip(entries, codes, strict=True):
        uses = np.bincount(cluster * len(e) + c, minlength=k * len(e)).reshape(k, len(e))
        parts.append(np.stack([(uses * column).sum(axis=1) for column in e.T], axis=1))
    return np.concatenate(parts, axis=1)


def _pack(ids: list, vectors: np.ndarray) -> pa.RecordBatch:
    entries, codes = encode(vectors)
    kinds = [np.uint16 if len(e) <= 1 << 16 else np.uint32 for e in entries]
    row = {
        "ids": pa.array([ids], pa.list_(pa.int64())),
        "n": pa.array([len(vectors)], pa.int64()),
        "codes": pa.array([b"".join(c.astype(k).tobytes() for c, k in zip(codes, kinds, strict=True))], pa.binary()),
        "entries": pa.array([b"".join(e.astype(np.int32).tobytes() for e in entries)], pa.binary()),
        "sizes": pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
    }
    return pa.RecordBatch.from_pydict(row)


def _unpack(n: int, codes: bytes, entries: bytes, sizes: list[int], dims: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    found, used, at, lo = [], [], 0, 0
    for block, size in enumerate(sizes):
        width = min(WIDTH, dims - block * WIDTH)
        found.append(np.frombuffer(entries, np.int32, size * width, at).reshape(size, width).astype(np.int64))
        at += 4 * size * width
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        used.append(np.frombuffer(codes, kind, n, lo).astype(np.int64))
        lo += used[-1].size * np.dtype(kind).itemsize
    return found, used


def encoded(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """Chunks of (vec_id, embedding), whose embeddings all are ``kept``, written as dictionaries and codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK - held or CHUNK):
                some = batch.slice(lo, CHUNK)
                ids += some.column("vec_id").to_pylist()
                parts.append(integers(some.column("embedding").flatten().to_numpy(zero_copy_only=False), dims))
                held += some.num_rows
                while held >= CHUNK:
                    whole = np.concatenate(parts)
                    yield _pack(ids[:CHUNK], whole[:CHUNK])
                    ids, parts, held = ids[CHUNK:], [whole[CHUNK:]], held - CHUNK
        if held:
            yield _pack(ids, np.concatenate(parts))

    return materialize(vectors.mapInArrow(run, _ENCODED), "subvectors")


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column("n")[i].as_py()
            raw = [batch.column(c)[i].as_buffer() for c in ("codes", "entries")]
            yield batch.column("ids")[i].values, n, *_unpack(n, *raw, batch.column("sizes")[i].as_py(), dims)


def _round(chunks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """(vectors, exact component sums) of each cluster."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n, entries, codes in _chunks(batches, dims):
            cluster, _ = nearest(entries, codes, centroids, n)
            total = sums(entries, codes, cluster, k)
            count = np.bincount(cluster, minlength=k)
            numbers = np.repeat(np.arange(k), dims)
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(numbers, pa.int64()),
                    "dim": pa.array(np.tile(np.arange(dims), k), pa.int64()),
                    "n": pa.array(np.repeat(count, dims), pa.int64()),
                    "total": pa.array(total.ravel(), pa.int64()),
                }
            )

    found = chunks.mapInArrow(run, "cluster long, dim long, n long, total long").groupBy("cluster", "dim")
    # sums of sums need more than 64 bits on large tables
    found = found.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    counts, totals = np.zeros(k, np.int64), [[0] * dims for _ in range(k)]
    for row in found.collect():  # 8 x 64 rows, whatever the table
        counts[row["cluster"]] = row["n"]
        totals[row["cluster"]][row["dim"]] = int(row["total"])
    return counts, totals


def cluster(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the kept rows of (vec_id, embedding).

    Null embeddings, other lengths, and null or non-finite components leave a row out; an empty table gives an empty
    result. Repeated rows each get a row. With fewer kept rows than ``k`` there are as many centroids as rows. Of the
    first centroids, rows that share an id, and so a hash, are ordered by their components; a null id comes last. Equal
    centroids: the smaller number takes the vectors, the other stays as it is. Other columns are ignored. Components beyond
    131,072 are an error, as distances are 64-bit integers.
    """
    spark = df.sparkSession
    rows = narrowed(df, vec_id="bigint", embedding="array<double>").filter(kept(dims=dims))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(named.asc_nulls_last(), "embedding").select("embedding").limit(k).collect()
    result = "vec_id long, cluster int, distance long"
    if not first:
        empty = spark.createDataFrame([], f"{result}, cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    centroids = np.concatenate([integers(np.array(r["embedding"], float), dims) for r in first])
    chunks = encoded(rows, dims)
    for _ in range(rounds):
        counts, totals = _round(chunks, centroids)
        after = [[t // int(n) for t in total] if n else list(old) for n, total, old in zip(counts, totals, centroids, strict=True)]
        centroids = np.array(after, np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, n, entries, codes in _chunks(batches, dims):
            number, distance = nearest(entries, codes, centroids, n)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    assigned = materialize(chunks.mapInArrow(assign, result), "clusters")
    of = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # at most k rows
    digest = {i: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for i, c in enumerate(centroids)}
    inertia = sum(r["s"] for r in of)
    known = [(r["cluster"], r["s"], inertia, digest[r["cluster"]]) for r in of]
    known = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The same in SQL: a pair of common tables per round."""
    kept_sql = f"len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    steps = [
        f"k as materialized (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v "
        f"from embeddings where embedding is not null and {kept_sql})",
        f"c0 as materialized (select cast(row_number() over (order by h nulls last, v) - 1 as integer) as c, v from "
        f"(select sha256('3:' || vec_id) as h, v from k order by h nulls last, v limit {CLUSTERS}))",
    ]
    away = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
    for n in range(ROUNDS + 1):
        steps.append(
            f"a{n} as materialized (select r, arg_min(c, d * 8 + c) as c, min(d) as d from "
            f"(select k.r, c.c, cast({away} as bigint) as d from k, c{n} c) group by r)"
        )
        if n < ROUNDS:
            # floor, not truncation
            mean = "cast((s - ((s % n) + n) % n) // n as bigint)"
            steps.append(
                f"u{n} as materialized (select c, list({mean} order by i) as v from (select c, i, sum(k.v[i])::hugeint as s, count(*)::hugeint as n "
                f"from a{n} join k using (r), range(1, 65) t(i) group by c, i) group by c)"
            )
            steps.append(f"c{n + 1} as materialized (select c.c, coalesce(u.v, c.v) as v from c{n} c left join u{n} u using (c))")
    last = f"a{ROUNDS}"
    return (
        "with " + ",\n".join(steps) + f"\nselect vec_id, a.c as cluster, a.d as distance, cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia, "
        f"cast(sum(a.d) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256 "
        f"from {last} a join k using (r) join c{ROUNDS} c on c.c = a.c"
    )


ORACLE = _oracle()
