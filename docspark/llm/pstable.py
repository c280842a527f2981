"""Near-duplicate vectors by Euclidean p-stable hashing, with an exact cosine check of what meets in a bucket.

How it runs:

1. equal vectors are one class; only classes are hashed. A class's unit vector has, in each of several tables, a key of
   several quantised Gaussian projections, floor((a.v + b) / width);
2. the number of projections grows with the logarithm of the number of classes, so that unrelated vectors stay few in a
   bucket, and the number of tables so that a pair at the threshold meets in one of them with probability ``RECALL``;
3. buckets are cut into cells of at most about ``CELL`` classes: a larger one becomes a grid of pairs of its parts, so that
   every pair of the bucket meets in exactly one cell, and no task holds a bucket;
4. a cell is one matrix product. A pair above the threshold counts in the first table where its keys agree, as both rows
   carry all their keys, so that no pair is ever sent on: a cell returns link counts and a spanning forest;
5. components come from the forests by large-star and small-star steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import mix, narrowed
from docspark.llm.jaccard import components
from docspark.runtime import materialize, maybe_broadcast, with_rows

THRESHOLD = 0.95
#: Probability that a pair just at the threshold shares a bucket; closer pairs have more.
RECALL = 0.99
#: Width of a quantised step, in units of the vectors' length.
WIDTH = 2.0
#: Unrelated classes that a bucket may hold on average, and classes of a part of a large bucket.
LOAD, CELL = 256, 256
SEED = 13
#: Cosines so near the threshold are computed again, each alone, so that a pair's verdict does not depend on its cell.
EDGE = 1e-9


def meet(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for two points at a distance."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def shape(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(projections per key, tables) for ``n`` classes."""
    near, far = meet(math.sqrt(2 - 2 * threshold)), meet(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(n / LOAD, 1)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; none may be zero."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def projections(dims: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions (a row each) and offsets, the same for the same numbers."""
    rng = np.random.default_rng([SEED, dims, k, tables])
    return rng.standard_normal((k * tables, dims)), rng.uniform(0, WIDTH, k * tables)


def keys(rows: np.ndarray, k: int, tables: int) -> np.ndarray:
    """The key of each unit row in each table, as 32 bits."""
    directions, offsets = projections(rows.shape[1], k, tables)
    steps = np.floor((rows @ directions.T + offsets) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(rows), tables, k)
    key = np.full((len(rows), tables), np.uint64(rows.shape[1]))
    for one in range(k):
        key = mix(key + steps[:, :, one])
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _bodies(batches: Iterator[pa.RecordBatch], single: bool) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes, or null if it links with nothing: null, empty, zero, or not finite."""
    kind = np.float32 if single else np.float64
    for batch in batches:
        column = batch.column("embedding")
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        flat = column.flatten()
        # a null component counts as not finite
        values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(kind) + kind(0)
        at = np.cumsum([0, *size])
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        ink = np.concatenate([[0], np.cumsum(values != 0)])
        good = (bad[at[1:]] == bad[at[:-1]]) & (ink[at[1:]] > ink[at[:-1]])
        raw = values.tobytes()
        step = values.itemsize
        body = [raw[a * step : b * step] if ok else None for a, b, ok in zip(at[:-1], at[1:], good, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(body, pa.binary())], ["vec_id", "body"])


def _rows(body: pa.Array, single: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of rows, their unit vectors) of each length that occurs."""
    size = pc.binary_length(body).to_numpy(zero_copy_only=False)
    kind = np.float32 if single else np.float64
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        raw = b"".join(body.take(pa.array(at)).to_pylist())
        yield at, unit(np.frombuffer(raw, kind).astype(np.float64).reshape(len(at), -1))


def _hash(k: int, tables: int, single: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, tables), np.int32)
            for at, rows in _rows(batch.column("body"), single):
                out[at] = keys(rows, k, tables)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, tables), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cls", "body", "weight")), column], ["cls", "body", "weight", "keys"])

    return run


def close(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with a cosine of at least the threshold."""
    cosine = left @ right.T
    i, j = np.nonzero(cosine >= THRESHOLD - EDGE)
    unsure = np.flatnonzero(cosine[i, j] < THRESHOLD + EDGE)
    keep = np.ones(len(i), bool)
    keep[unsure] = (left[i[unsure]] * right[j[unsure]]).sum(axis=1) >= THRESHOLD
    return i[keep], j[keep]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the edges."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _cell(table: int, part: np.ndarray, first: int, second: int, rows: np.ndarray, keys_: np.ndarray, weight: np.ndarray):
    """(links of each row, least row that it is joined to) inside one cell."""
    if first == second:
        left = right = np.arange(len(rows))
        i, j = close(rows, rows)
        i, j = i[i < j], j[i < j]
    else:
        left, right = np.flatnonzero(part == first), np.flatnonzero(part == second)
        i, j = close(rows[left], rows[right])
    a, b = left[i], right[j]
    seen = np.zeros(len(a), bool)
    for earlier in range(table):
        seen |= keys_[a, earlier] == keys_[b, earlier]
    a, b = a[~seen], b[~seen]
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, a, weight[b])
    np.add.at(links, b, weight[a])
    return links, forest(a, b, len(rows))


def _compare(single: bool):
    """Cells, whose rows lie together: (cls, links there, class that it is joined to)."""
    cell = ["tab", "key", "first", "second", "size"]

    def work(batch: pa.RecordBatch, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        tab, part, first, second = (batch.column(c).to_numpy() for c in ("tab", "part", "first", "second"))
        cls, weight = batch.column("cls").to_numpy(), batch.column("weight").to_numpy()
        every = batch.column("keys")
        own = np.stack([every.flatten().to_numpy()]).reshape(batch.num_rows, -1)
        vectors, where = {}, np.zeros(batch.num_rows, np.int64)
        of = batch.column("size").to_numpy()
        for at, rows in _rows(batch.column("body"), single):
            vectors[int(of[at[0]])] = rows
            where[at] = np.arange(len(at))
        found = [], [], []
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            if hi - lo < 2:
                continue
            rows = vectors[int(of[lo])][where[lo:hi]]
            links, root = _cell(int(tab[lo]), part[lo:hi], first[lo], second[lo], rows, own[lo:hi], weight[lo:hi])
            some = np.flatnonzero(links)
            found[0].append(cls[lo + some])
            found[1].append(links[some])
            found[2].append(cls[lo + root[some]])
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in found], ["cls", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            new = np.zeros(whole.num_rows, bool)
            new[0] = True
            for c in cell:
                values = whole.column(c).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            starts = np.flatnonzero(new)
            if len(starts) > 1:
                # the last cell may go on in the next batch
                yield from work(whole.slice(0, starts[-1]), starts)
            held = [whole.slice(starts[-1])]
        if held:
            yield from work(held[0], np.array([0, held[0].num_rows]))

    return run


def near_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding): rows whose cosine is 0.95 or more, chained.

    Rows that are null, empty or zero, or hold a null or non-finite component, link with nothing; nor do vectors of
    different lengths. Repeated rows each get a row and count as each other's links. ``component_id`` is the smallest id that
    is not null, and null if there is none; a row without an id is kept only then. Other columns are ignored; an empty table
    gives an empty result. No link is below the threshold; a pair is missed with a probability of at most 1 - ``RECALL``.
    """
    kind = dict(df.dtypes)["embedding"]
    single = kind == "array<float>"
    rows = narrowed(df, vec_id="bigint", embedding=kind if single else "array<double>")
    rows = rows.mapInArrow(lambda batches: _bodies(batches, single), "vec_id long, body binary")
    rows = materialize(rows.withColumn("name", F.unhex(F.md5("body"))), "vectors")
    classes = rows.filter("body is not null").groupBy("body").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
    classes, cls = with_rows(classes, "vector-classes")
    classes = classes.withColumnRenamed(cls, "cls")
    n = classes.count()
    k, tables = shape(n)
    hashed = classes.select("cls", "body", "weight").mapInArrow(_hash(k, tables, single), "cls long, body binary, weight long, keys array<int>")
    hashed = materialize(hashed, "vector-keys")

    each = hashed.select("cls", F.octet_length("body").alias("size"), F.posexplode("keys").alias("tab", "key"))
    large = each.groupBy("tab", "key", "size").count().filter(F.col("count") > CELL)
    large = large.select("tab", "key", "size", F.ceil(F.col("count") / CELL).cast("int").alias("parts"))
    large = materialize(large, "large-buckets")
    spread = hashed.select("*", F.octet_length("body").alias("size"), F.posexplode("keys").alias("tab", "key"))
    spread = spread.join(maybe_broadcast(large), ["tab", "key", "size"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int"))
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.withColumn("first", F.least("part", "with")).withColumn("second", F.greatest("part", "with"))
    cell = ["tab", "key", "first", "second", "size"]
    dealt = spread.select("cls", "body", "weight", "keys", "part", *cell).repartition(*cell).sortWithinPartitions(*cell)
    found = materialize(dealt.mapInArrow(_compare(single), "cls long, links long, root long"), "vector-links")

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    named = classes.join(links, "cls", "left").join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    count = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    named = named.join(least, "component").select(F.unhex(F.md5("body")).alias("name"), count.alias("n_links"), "component_id")
    out = rows.select("vec_id", "name").join(materialize(named, "vector-components"), "name", "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
