"""Pack documents into windows with their lexical neighbours, found by BM25 in a sharded inverted index."""

from __future__ import annotations

import zlib
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import mix, narrowed, release, releasing
from docspark.llm.encode import CHUNKS, UNITS, encoder, forget
from docspark.runtime import materialize

#: Tokens of a full sequence.
WINDOW = 2048
#: A shard of the index is closed at so many tokens or documents.
SHARD_TOKENS, SHARD_DOCS = 1 << 20, 8192
#: Terms of a query: all of the seed. BM25's constants.
TERMS, K1, B = None, 1.2, 0.75
#: Terms by which a document finds its place inside its cluster, and neighbours that are ordered at a time.
KEYS, PAGE = 3, 64
#: A term that more than one in so many documents of a shard have is indexed by rows instead of lists.
OFTEN = 8
#: Documents for each partition whose places tell where the partitions end, and documents whose vectors the clusters are fitted on.
SAMPLE, FITTED = 100, 4096
#: Clusters at most, sampled documents for each at least, components of a document's vector, and rounds of the fit.
CLUSTERS, EACH, WIDTH, ROUNDS = 256, 16, 512, 8
#: Documents whose terms are counted at a time.
GROUP = 256
#: Id after each document.
END = 1


class Stats:
    """Documents, their average length and each term's document frequency, over a whole table."""

    def __init__(self, n: int, mean: float, df: np.ndarray):
        self.n, self.mean, self.df = n, max(mean, 1), df
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Stats:
        width = int(max((d.max() for d in docs if len(d)), default=0)) + 1
        df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=width)
        return cls(len(docs), np.mean([len(d) for d in docs]), df)

    def weight(self, term: np.ndarray, tf: np.ndarray, size: np.ndarray) -> np.ndarray:
        norm = (K1 * (1 - B + B * size / self.mean)).astype(np.float32)
        return self.idf[term] * tf * (K1 + 1) / (tf + norm)


def terms_of(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of all documents, sorted."""
    sizes = [len(d) for d in docs]
    keys = np.repeat(np.arange(len(docs), dtype=np.int64) << 32, sizes)
    keys, tf = np.unique(keys + (np.concatenate(docs) if docs else 0), return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, tf


class Vectors:
    """A vector per document: its weighted terms, each added to or taken from one component.

    Weights are rounded to integers, so that a task that runs again, on whatever machine, places a document alike.
    """

    def __init__(self, stats: Stats):
        self.stats = stats
        h = mix(np.arange(len(stats.df)) + (1 << 32))
        self.at, self.sign = (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1, -1)

    def weighted(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, weight) of the terms that other documents have too."""
        doc, term, tf = terms_of(docs)
        shared = self.stats.df[term] > 1
        doc, term, tf = doc[shared], term[shared], tf[shared]
        sizes = np.array([len(d) for d in docs], np.int64)
        return doc, term, self.stats.weight(term, tf, sizes[doc])

    def of(self, n: int, doc: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        whole = np.rint(weight * self.stats.idf[term] * 16) * self.sign[term]
        return np.bincount(doc * WIDTH + self.at[term], whole, n * WIDTH).reshape(n, WIDTH)


def clusters(sample: np.ndarray) -> np.ndarray:
    """Centroids by cosine of the sampled vectors, as integers, each beside one that is like it."""
    sample = sample[np.any(sample, axis=1)].astype(np.float32)
    count = min(CLUSTERS, len(sample) // EACH)
    if count < 2:
        return np.zeros((1, WIDTH))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    found = sample[np.linspace(0, len(sample) - 1, count).astype(int)]
    for _ in range(ROUNDS):
        near = (sample @ found.T).argmax(1)
        total = np.zeros_like(found)
        np.add.at(total, near, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        found = np.where(size > 0, total / np.maximum(size, 1e-9), found)
    like, order = found @ found.T, [0]
    left = np.ones(count, bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, like[order[-1]], -2).argmax()))
        left[order[-1]] = False
    return np.rint(found[order] * 1024).astype(np.float64)


class Places:
    """The cluster of a document, and ``KEYS`` of its terms, each drawn by weight with the same dice for all documents.

    Two documents draw the same term with the probability that their weighted terms overlap, so that sorting by
    these keys brings likely neighbours together inside a cluster too; later keys divide the documents of a term that
    is drawn often.
    """

    def __init__(self, stats: Stats, centroids: np.ndarray):
        self.vectors, self.centroids = Vectors(stats), np.ascontiguousarray(centroids.T)
        dice = mix(np.arange(KEYS * len(stats.df))).reshape(KEYS, -1)
        self.dice = -np.log((dice >> np.uint64(11)).astype(np.float64) / 2**53 + 2.0**-54)

    def of(self, docs: list[np.ndarray]) -> np.ndarray:
        """A row per document: cluster and terms; -1 where it has no term that another has."""
        out = [np.empty((0, 1 + KEYS), np.int32)]
        for lo in range(0, len(docs), GROUP):
            part = docs[lo : lo + GROUP]
            out.append(np.full((len(part), 1 + KEYS), -1, np.int32))
            doc, term, weight = self.vectors.weighted(part)
            if not len(doc):
                continue
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            has = doc[first]
            near = (self.vectors.of(len(part), doc, term, weight) @ self.centroids).argmax(1)
            out[-1][has, 0] = near[has]
            worth = np.maximum(weight.astype(np.float64) ** 2, 1e-30)
            for k in range(KEYS):
                cost = self.dice[k, term] / worth
                least = np.minimum.reduceat(cost, first)
                at = np.flatnonzero(cost == np.repeat(least, np.diff(np.append(first, len(doc)))))[::-1]
                out[-1][doc[at], 1 + k] = term[at]
        return np.concatenate(out)


class Index:
    """Inverted index of one shard: BM25 weights by term, and the terms of each document that another has too."""

    def __init__(self, docs: list[np.ndarray], stats: Stats | None = None):
        self.n = len(docs)
        stats = stats or Stats.of(docs)
        size = np.array([len(d) for d in docs], np.int64)
        doc, term, tf = terms_of(docs)
        here = np.bincount(term, minlength=len(stats.df))
        weight = stats.weight(term, tf.astype(np.float32), size[doc])
        shared = here[term] > 1
        self.first = np.searchsorted(doc[shared], np.arange(self.n + 1))
        self.term = term[shared].astype(np.int32)
        # terms of many of the documents have a row with a weight for each document, the others a list
        often = np.flatnonzero(here * OFTEN > max(self.n, OFTEN))
        self.row = np.full(len(here), -1, np.int32)
        self.row[often] = np.arange(len(often))
        many = self.row[term] >= 0
        self.rows = np.zeros((len(often), self.n), np.float32)
        self.rows[self.row[term[many]], doc[many]] = weight[many]
        doc, term, weight = doc[~many], term[~many], weight[~many]
        by_term = np.argsort(term, kind="stable")
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(here)))])
        self.doc, self.weight = doc[by_term].astype(np.int32), weight[by_term]

    def scores(self, seed: int) -> np.ndarray:
        t = self.term[self.first[seed] : self.first[seed + 1]]
        row = self.row[t]
        t = t[row < 0]
        lo, size = self.start[t], self.start[t + 1] - self.start[t]
        at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
        return np.bincount(self.doc[at], self.weight[at], self.n) + self.rows[row[row >= 0]].sum(0)

    def ranked(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with the seed, best first; ordered a page at a time."""
        score = self.scores(seed)
        found = np.flatnonzero((score > 0) & unused)
        while len(found):
            page, rest = found, found[:0]
            if len(found) > PAGE:
                # equals of the last one come along, so that pages do not change the order
                enough = score[found] >= -np.partition(-score[found], PAGE - 1)[PAGE - 1]
                page, rest = found[enough], found[~enough]
            yield from page[np.lexsort((page, -score[page]))].tolist()
            found = rest

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        return np.fromiter(self.ranked(seed, unused), np.int64)


def shard_ends(tokens: int, docs: int, edge: bool) -> bool:
    """Whether a shard of so much is closed before the next document; ``edge``: that one is of another cluster."""
    return tokens >= SHARD_TOKENS or docs >= SHARD_DOCS or edge and (tokens >= SHARD_TOKENS // 2 or docs >= SHARD_DOCS // 2)


def order_of(sizes: list[int], index: Index, window: int) -> Iterator[tuple[int, int, int]]:
    """(document, start, length) of the pieces in the order in which they fill windows.

    The next unused document seeds a window, and its best unused neighbours follow; with none left, the next seed
    does. What does not fit is cut and opens the next window, whose neighbours are sought for the cut document.
    """
    unused = np.ones(len(sizes), bool)
    room, seed, near, next_ = window, -1, iter(()), 0
    while True:
        pick = next((d for d in near if unused[d]), None)
        if pick is None:
            while next_ < len(sizes) and not unused[next_]:
                next_ += 1
            if next_ == len(sizes):
                return
            pick = next_
            seed = -1
        unused[pick] = False
        at = 0
        while at < sizes[pick]:
            length = min(room, sizes[pick] - at)
            yield pick, at, length
            at, room = at + length, room - length
            if not room:
                room, seed = window, -1
        if seed < 0:
            seed, near = pick, (index.ranked(pick, unused) if room < window else iter(()))


def sequences(pieces: Iterator[tuple[int, int, int]], total: int, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset). The tokens after the last full window make sequences of the powers
    of two in their number, so that none is padded."""
    rest = total % window
    ends = [window] * (total // window) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    number, used = 0, 0
    for doc, start, length in pieces:
        while length:
            take = min(length, ends[number] - used)
            yield doc, start, take, number, used
            start, length, used = start + take, length - take, used + take
            if used == ends[number]:
                number, used = number + 1, 0


FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack_shard(docs: list[np.ndarray], window: int, stats: Stats | None = None) -> tuple[list[tuple[int, ...]], int]:
    """((document, start, length, crc32 of the ids, document's size, sequence, offset) of each piece, sequences made)."""
    sizes = [len(d) for d in docs]
    rows = []
    for doc, start, length, number, offset in sequences(order_of(sizes, Index(docs, stats), window), sum(sizes), window):
        ids = docs[doc][start : start + length]
        rows.append((doc, start, length, zlib.crc32(ids.tobytes()), sizes[doc], number, offset))
    return rows, (rows[-1][5] + 1 if rows else 0)


def _encoded(tokenizer: str, end: int, caches: tuple[int, int]):
    """Of each text a row with its ids, two bytes each if they fit; of each task a row per term with its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, at = encoder(tokenizer, *caches).encode_all, TaskContext.get().partitionId() << 33
        stop, seen = np.array([end], np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            ids, sizes, docs = [], [], []
            for found in encode_all(batch.column("text")):
                doc = np.concatenate([found, stop])
                ids.append(doc.astype(np.uint16 if doc.max() < 1 << 16 else np.uint32).tobytes())
                sizes.append(len(doc))
                docs.append(doc)
            n = len(ids)
            for lo in range(0, n, GROUP):
                more = np.bincount(terms_of(docs[lo : lo + GROUP])[1])
                more[: len(seen)] += seen[: len(more)]
                seen = np.concatenate([more, seen[len(more) :]])
            cols = [batch.column("doc_id"), pa.array(range(at, at + n), pa.int64()), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64())]
            # what a batch leaves free lies between entries of the caches and would add up
            found = doc = None
            ids, docs = [], []
            release()
            yield pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], _ENCODED)
            at += n
        terms = np.flatnonzero(seen)
        n = len(terms)
        cols = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(terms, pa.int64()), pa.array(seen[terms], pa.int64())], _ENCODED)

    return run


_ENCODED = ["doc_id", "row", "ids", "n", "term", "seen"]


def _ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for ids, n in zip(batch.column("ids"), batch.column("n").to_pylist(), strict=True):
        body = ids.as_buffer()
        yield np.frombuffer(body, np.uint16 if body.size == 2 * n else np.uint32)


def pack(
    df: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, caches: tuple[int, int] = (UNITS, CHUNKS)
) -> DataFrame:
    """Pieces of the sequences that hold every token of (doc_id, text) once, each text followed by ``end``.

    Texts are encoded and written once; document frequencies and the average length are those of the whole table.
    Documents are then sorted by the nearest of at most ``CLUSTERS`` centroids, fitted on a bounded sample of about
    ``FITTED`` documents, and by terms, so that likely neighbours from anywhere in the table lie side by side. Each run of a
    bounded number of tokens or documents is a shard, packed on its own; one that is half full ends where a cluster does.
    The sort ends with the row's place, so that no term, however common, fills a task, and a task that runs again gives the same pieces.
    Neighbours that the sort puts in different shards are not found. Sequence ids hold the partition and the number
    in it.

    A null text is the end id alone. Rows that repeat are packed as often; a null id stays null; other columns are
    ignored. An empty table has no sequence. ``caches`` are the entries of the encoder's two caches: fewer take less memory
    and more time.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    made = narrowed(df, doc_id="bigint", text="string").mapInArrow(
        releasing(_encoded(tokenizer, end, caches)), "doc_id long, row long, ids binary, n long, term long, seen long"
    )
    made = materialize(made, "encoded")
    n, mean = made.agg(F.count("n"), F.coalesce(F.avg("n"), F.lit(0.0))).first()
    # a row per entry of the vocabulary, however large the table
    often = made.filter("term is not null").groupBy("term").agg(F.sum("seen").alias("seen")).toArrow()
    seen = np.zeros(1 + max(often.column("term").to_pylist(), default=0), np.int64)
    seen[often.column("term").to_numpy()] = often.column("seen").to_numpy()
    stats = Stats(n, mean, seen)
    keys = ["cluster", *(f"k{i}" for i in range(KEYS))]
    texts = made.filter("term is null").select(_ENCODED[:4])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Vectors(stats)
        for batch in batches:
            docs = list(_ids(batch))
            for lo in range(0, len(docs), GROUP):
                part = docs[lo : lo + GROUP]
                found = of.of(len(part), *of.weighted(part)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("row")[lo : lo + GROUP], pa.array([v.tobytes() for v in found], pa.binary())], ["row", "vector"])

    picked = F.pmod(F.xxhash64("row"), F.lit(max(1, n // FITTED))) == 0
    sample = texts.filter(picked).mapInArrow(releasing(vectors), "row long, vector binary").toArrow().sort_by("row")
    centroids = clusters(np.array([np.frombuffer(v, np.float32) for v in sample.column("vector").to_pylist()]).reshape(-1, WIDTH))

    def place(ends: list[tuple[int, ...]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            places = Places(stats, centroids)
            for batch in batches:
                drawn = places.of(list(_ids(batch)))
                part = [bisect(ends, (*k, r)) for k, r in zip(drawn.tolist(), batch.column("row").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k) for k in drawn.T), pa.array(part, pa.int32())], [*_ENCODED[:4], *keys, "part"])

        return releasing(run)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the process may have encoded texts before
        forget()
        release()
        base = TaskContext.get().partitionId() << 33
        ids: list = []
        docs: list[np.ndarray] = []
        held, last = 0, None

        def close() -> pa.RecordBatch:
            nonlocal base, ids, docs, held
            rows, made = pack_shard(docs, window, stats)
            cols = list(zip(*rows, strict=True))
            out = [[ids[d] for d in cols[0]], *cols[1:5], [base + n for n in cols[5]], cols[6]]
            base, ids, docs, held = base + made, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], FIELDS)

        for batch in batches:
            for doc_id, doc, cluster in zip(batch.column("doc_id").to_pylist(), _ids(batch), batch.column("cluster").to_pylist(), strict=True):
                if docs and shard_ends(held, len(docs), cluster != last):
                    yield close()
                last = cluster
                docs.append(doc.astype(np.uint32))
                ids.append(doc_id)
                held += len(doc)
        if docs:
            yield close()

    # ranges of places, from a bounded sample: a range sort of Spark's would draw all places twice
    kinds = ", ".join(["doc_id long, row long, ids binary, n long", *(f"{k} int" for k in keys), "part int"])
    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(n * mean) // SHARD_TOKENS)))
    every = max(1, n // (SAMPLE * parts))
    some = texts.filter(F.pmod(F.xxhash64("row"), F.lit(every)) == 0) if parts > 1 else texts.limit(0)
    seen_places = sorted(map(tuple, some.mapInArrow(place([]), kinds).select(*keys, "row").toArrow().to_pandas().itertuples(index=False)))
    ends = [seen_places[len(seen_places) * k // parts] for k in range(1, parts)] if seen_places else []
    placed = texts.mapInArrow(place(ends), kinds)
    ranged = placed.repartitionById(parts, F.col("part")).sortWithinPartitions(*keys, "row")
    return ranged.select("doc_id", "ids", "n", "cluster").mapInArrow(releasing(run), ", ".join(f"{f} long" for f in FIELDS))
