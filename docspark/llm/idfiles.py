"""Token-id files: patched frame-of-reference blocks, with the start of every block and of every document.

A file is ``MAGIC``, the bodies of its blocks one after the other, the index, and a footer of fixed size:

* body: the block's values minus their least, ``width`` bits each, in 64-bit words, then the positions (1 byte) and
  values (4 bytes) of those that need more bits;
* index: least value (u4), width (u1), number of exceptions (u1) and body's start (u8) of each block, then id (i8), a
  null mark (u1) and number of ids (u8) of each document;
* footer: numbers of blocks, documents and ids, and the index's start, as u8.

All numbers are little-endian. The last block is filled up with its least value.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import narrowed
from docspark.llm.encode import encoder
from docspark.runtime import materialize, work_path
from docspark.sources.io import AtomicFile, open_input

MAGIC = b"PFORIDS1"
#: Ids per block; a position inside a block fits one byte.
BLOCK = 128
#: Share of a block's values that its width must hold; the others are exceptions.
PERCENTILE = 0.9
#: Blocks encoded or decoded at a time.
FRAME = 4096
#: Id after each document.
END = 2
_LANES = np.arange(BLOCK)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) values of ``width`` bits as (blocks, 2 * width) 64-bit words."""
    lanes = np.ascontiguousarray(values.T.astype(np.uint64))
    out = np.zeros((2 * width, len(values)), np.uint64)
    for i in range(BLOCK if width else 0):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = np.ascontiguousarray(words.T)
    out = np.zeros((BLOCK, words.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK if width else 0):
        word, shift = divmod(i * width, 64)
        got = rows[word] >> np.uint64(shift)
        if shift + width > 64:
            got |= rows[word + 1] << np.uint64(64 - shift)
        out[i] = got & mask
    return np.ascontiguousarray(out.T)


def _spots(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs of ``lengths`` from ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, dict[str, np.ndarray]]:
    """(bodies, index) of ids whose number is a multiple of ``BLOCK``; body starts count from 0."""
    rows = ids.reshape(-1, BLOCK)
    least = rows.min(axis=1) if len(rows) else np.empty(0, np.uint32)
    over = rows - least[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bits(np.partition(over, at, axis=1)[:, at]) if len(rows) else np.empty(0, np.int64)
    big = over >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_big = big.sum(axis=1)
    size = 16 * width + 5 * n_big
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    out = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if w:
            words = _pack(np.where(big[mine], 0, over[mine]), int(w))
            out[(start[mine, None] + np.arange(16 * w)).ravel()] = words.astype("<u8").view(np.uint8).ravel()
    block, lane = np.nonzero(big)
    if len(block):
        out[_spots(start + 16 * width, n_big)] = lane
        out[_spots(start + 16 * width + n_big, 4 * n_big)] = over[block, lane].astype("<u4").view(np.uint8)
    return out.tobytes(), {"least": least.astype("<u4"), "width": width.astype("u1"), "n_big": n_big.astype("u1"), "start": start.astype("<u8")}


def decode_blocks(body: np.ndarray, index: dict[str, np.ndarray], base: int) -> np.ndarray:
    """Ids of consecutive blocks whose bodies are ``body``, which starts at ``base`` of the file."""
    width, n_big = index["width"].astype(np.int64), index["n_big"].astype(np.int64)
    start = index["start"].astype(np.int64) - base
    out = np.zeros((len(width), BLOCK), np.uint64)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if w:
            raw = body[(start[mine, None] + np.arange(16 * w)).ravel()]
            out[mine] = _unpack(raw.view("<u8").reshape(len(mine), 2 * w), int(w))
    if n_big.sum():
        block = np.repeat(np.arange(len(width)), n_big)
        lane = body[_spots(start + 16 * width, n_big)]
        out[block, lane] = body[_spots(start + 16 * width + n_big, 4 * n_big)].view("<u4")
    return (out + index["least"].astype(np.uint64)[:, None]).astype("<u4").ravel()


class Writer:
    """Writes one file; a document's ids are given once, and only a frame of blocks is held."""

    def __init__(self, path: str, attempt: str):
        self.file = AtomicFile(path, attempt)
        self.file.stream.write(MAGIC)
        self.size, self.held, self.n_held = len(MAGIC), [], 0
        self.index: dict[str, list] = {"least": [], "width": [], "n_big": [], "start": []}
        self.doc_ids: list = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= FRAME * BLOCK:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for lo in range(0, n, FRAME * BLOCK):
            body, index = encode_blocks(ids[lo : min(lo + FRAME * BLOCK, n)])
            index["start"] = (index["start"] + np.uint64(self.size)).astype("<u8")
            for k, v in index.items():
                self.index[k].append(v)
            self.file.stream.write(body)
            self.size += len(body)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            self.held = [np.concatenate([ids, np.full(-len(ids) % BLOCK, ids[len(ids) // BLOCK * BLOCK :].min() if len(ids) % BLOCK else 0, np.uint32)])]
            self._flush(len(self.held[0]))
        n_blocks = sum(map(len, self.index["least"]))
        for k, kind in (("least", "<u4"), ("width", "u1"), ("n_big", "u1"), ("start", "<u8")):
            self.file.stream.write(np.concatenate([np.empty(0, kind), *self.index[k]]).astype(kind).tobytes())
        none = np.array([d is None for d in self.doc_ids], "u1")
        self.file.stream.write(np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes())
        self.file.stream.write(none.tobytes())
        self.file.stream.write(np.array(self.counts, "<u8").tobytes())
        self.file.stream.write(np.array([n_blocks, len(self.counts), sum(self.counts), self.size], "<u8").tobytes())
        self.file.close()


class Reader:
    """Reads one file: its index at once, its blocks a frame at a time or from any document on."""

    def __init__(self, path: str):
        self.file = open_input(path)
        size = self.file.size()
        self.file.seek(size - 32)
        blocks, docs, self.n_ids, at = np.frombuffer(self.file.read(32), "<u8").astype(int)
        self.file.seek(0)
        if self.file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a file of token ids: {path}")
        self.end = int(at)
        self.file.seek(self.end)
        take = lambda n, kind: np.frombuffer(self.file.read(int(n) * np.dtype(kind).itemsize), kind)
        self.index = {k: take(blocks, kind) for k, kind in (("least", "<u4"), ("width", "u1"), ("n_big", "u1"), ("start", "<u8"))}
        ids, none = take(docs, "<i8"), take(docs, "u1")
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, none, strict=True)]
        self.counts = take(docs, "<u8").astype(np.int64)

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """Ids of the blocks from ``lo`` to ``hi``."""
        index = {k: v[lo:hi] for k, v in self.index.items()}
        if not len(index["start"]):
            return np.empty(0, np.uint32)
        a = int(index["start"][0])
        b = int(self.index["start"][hi]) if hi < len(self.index["start"]) else self.end
        self.file.seek(a)
        return decode_blocks(np.frombuffer(self.file.read(b - a), np.uint8), index, a)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        a = int(self.counts[:k].sum())
        b = a + int(self.counts[k])
        got = self.blocks(a // BLOCK, -(-b // BLOCK))
        return got[a - a // BLOCK * BLOCK :][: b - a]

    def frames(self) -> Iterator[np.ndarray]:
        n = self.n_ids
        for lo in range(0, len(self.index["start"]), FRAME):
            ids = self.blocks(lo, min(lo + FRAME, len(self.index["start"])))
            yield ids[: n - lo * BLOCK]

    def close(self) -> None:
        self.file.close()


def _apart(spans: DataFrame) -> bool:
    """Whether spans (lo, hi, nulls, rows) of partitions do not overlap: null ids, which come first, alone in one of them."""
    found = spans.collect()  # a row per partition
    found.sort(key=lambda s: (s["nulls"] == 0, s["lo"] is not None, s["lo"], s["hi"]))
    ends = [s for s in found if s["lo"] is not None]
    return sum(s["nulls"] > 0 for s in found) < 2 and all(a["hi"] <= b["lo"] for a, b in zip(ends, ends[1:], strict=False))


def _written(docs: DataFrame, path: str, tokenizer: str, end: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encode, writer, stop = encoder(tokenizer).encode, None, np.array([end], np.uint32)
        file = f"{path}/part-{context.partitionId():06d}.ids"
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if writer is None:
                    writer = Writer(file, f"{context.stageId()}-{context.taskAttemptId()}")
                writer.add(doc_id, np.concatenate([encode(text.as_py() or ""), stop]))
        if writer is not None:
            writer.close()
            known = [d for d in writer.doc_ids if d is not None]
            sizes = {"nulls": len(writer.doc_ids) - len(known), "rows": len(writer.doc_ids), "n_ids": sum(writer.counts)}
            row = {"path": file, "lo": min(known, default=None), "hi": max(known, default=None), **sizes}
            yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.string() if k == "path" else pa.int64()) for k, v in row.items()})

    ordered = docs.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return materialize(ordered.mapInArrow(run, "path string, lo long, hi long, nulls long, rows long, n_ids long"), "id-files")


def write_ids(df: DataFrame, path: str, tokenizer: str, end: int = END) -> DataFrame:
    """Write the ids of (doc_id, text) in ascending doc_id to files below ``path``, one per partition.

    Returns a row per file: path, part (their order), n_docs, n_ids. Tables that lie in ranges of ids already, as most
    do, are not shuffled; others are dealt by ranges first. The order of files is that of the ids that their tasks
    wrote. A task writes under a name of its own and moves the file into place, so that a repeated task replaces its
    file. A null text is empty; null ids come first; an empty table gives no file; other columns are ignored.
    """
    docs = narrowed(df, doc_id="bigint", text="string")
    ids = docs.select("doc_id").groupBy(F.spark_partition_id().alias("part"))
    spans = ids.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    files = _written(docs, f"{path}/as-is", tokenizer, end) if _apart(spans) else None
    if files is None or not _apart(files):
        # also where the plan with texts has other partitions than that of the ids alone
        files = _written(docs.repartitionByRange(F.col("doc_id").asc_nulls_first()), f"{path}/by-range", tokenizer, end)
    order = Window.orderBy(F.col("nulls") == 0, F.col("lo").asc_nulls_first(), "hi", "path")  # a row per file
    return files.select("path", (F.row_number().over(order) - 1).cast("long").alias("part"), F.col("rows").alias("n_docs"), "n_ids")


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files that ``write_ids`` returned.

    ``start`` is the number of ids of all documents before. A file is read by one task, a frame at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    spread = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = spread.repartition(max(1, files.count()), "part") if not files.isEmpty() else spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader = Reader(path)
                ends = np.cumsum(reader.counts)
                crc, done, k = 0, 0, 0
                crcs = np.zeros(len(ends), np.int64)
                for ids in reader.frames():
                    at = 0
                    while at < len(ids):
                        take = min(int(ends[k]) - done, len(ids) - at)
                        crc = zlib.crc32(ids[at : at + take].tobytes(), crc)
                        at, done = at + take, done + take
                        if done == ends[k]:
                            crcs[k], crc, k = crc, 0, k + 1
                reader.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids, pa.int64()), pa.array(base + ends - reader.counts), pa.array(reader.counts), pa.array(crcs)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return spread.select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of a table to the shared folder and read the files back."""
    return read_ids(write_ids(df, work_path(df.sparkSession, "ids"), tokenizer))
