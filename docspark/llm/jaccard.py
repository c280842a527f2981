"""Exact Jaccard join of word n-gram sets by T-occurrence search over a sharded inverted index.

How it runs:

1. every text becomes its set of shingle hashes; texts with equal sets are one class, and only classes are compared;
2. (class, shingle) postings go, packed, to shards by shingle; a shard keeps the lists that hold two classes or more.
   A shingle that a thousandth of the texts share is known beforehand and dealt by class instead;
3. a class can only have a partner if a share of its shingles as large as the threshold lies in kept lists; nearly all
   classes end here. The others are the index, with shingles in order of their list's length;
4. links are first sought between each class and one hub per short list, which joins dense groups without making
   all their pairs. Then T-occurrence search finds every pair of classes that is not joined yet: a class's short lists
   are heap-merged, and what occurs in them is probed in the remaining, long lists by binary search (DivideSkip);
5. components come from the links by large-star and small-star steps;
6. all links lie inside components, so each component's classes are compared once more, to count every class's links:
   in cells of two parts of the component, as products of blocks of the indicator matrix (class, shingle). No pair leaves a cell.

Sets are told apart by 64-bit hashes, and shingles are compared by the 48 leading bits of theirs: two that agree in
those would count as equal.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import buffers, groups, mix, narrowed, release, releasing, windows, words
from docspark.runtime import materialize, maybe_broadcast, with_rows

SHINGLE = 5
#: Link when ``PERCENT`` % of the union is shared.
PERCENT = 75
#: Postings per shard of the index.
SHARD = 1_000_000
#: Bytes of text made into postings at a time.
BLOCK = 4 << 20
#: A shingle is frequent if a block, and then the table, has it in one text of so many; and the least such count.
FREQUENT, LEAST_FREQUENT = 1000, 1000
#: Rows per file of the small tables between the steps.
ROWS = 250_000
#: Classes of a part of a component, and shingles of a block, when links are counted.
PART, COLUMNS = 256, 4096
#: Entries of a list that one merge takes; longer lists are cut by candidate.
LIST = 4096
_CUT, _LONGEST = np.uint64(16), 0x7FFF


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles of each text, ordered by text and hash; A-Z count as a-z.

    A text with fewer than ``size`` words has one shingle, the whole; one without words has none.
    """
    doc, word = words(data, offsets, lower=True)
    at, h = windows(doc, word, size)
    owner = doc[at]
    n_words = np.bincount(doc, minlength=len(offsets) - 1)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = mix(n_words[short].astype(np.uint64))
        for k in range(size - 1):
            more = n_words[short] > k
            whole[more] = mix(whole[more] + word[first[more] + k])
        owner, h = np.concatenate([owner, short]), np.concatenate([h, whole])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        owner, h = owner[new], h[new]
    return owner, h


def classes_of(owner: np.ndarray, h: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(set size, class) of each text; the class is a hash of the set, 0 for the empty one."""
    size = np.bincount(owner, minlength=n_texts)
    total = np.zeros(n_texts, np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        total[filled] = mix(np.add.reduceat(mix(h), np.searchsorted(owner, filled)) + size[filled].astype(np.uint64))
    return size, total.view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for lo, hi in groups(data, offsets, BLOCK):
            own = offsets[lo : hi + 1]
            owner, h = shingles(data[own[0] : own[-1]], own - own[0])
            size, cls = classes_of(owner, h, hi - lo)
            yield batch, lo, hi, owner, h, size, cls


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, and a row per shingle that is frequent in its block."""
    names = ["doc_id", "cls", "n", "token", "seen"]
    kinds = [pa.int64()] * 5
    for batch, lo, hi, _, h, size, cls in _blocks(batches):
        ids = batch.column("doc_id").slice(lo, hi - lo)
        none = pa.nulls(hi - lo, pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(cls), pa.array(size), none, none], names)
        token, seen = np.unique(h & ~((np.uint64(1) << _CUT) - np.uint64(1)), return_counts=True)
        often = seen >= max(4, (hi - lo) // FREQUENT)
        if often.any():
            none = pa.nulls(int(often.sum()), pa.int64())
            cols = [none, none, none, pa.array(token[often].view(np.int64)), pa.array(seen[often])]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(cols, kinds, strict=True)], names)


def _pack(token: np.ndarray, cls: np.ndarray, n: np.ndarray) -> bytes:
    """Postings sorted by token; bytes of equal weight lie together, so that the leading ones compress."""
    kinds, of = np.unique(cls, return_inverse=True)
    sizes = np.zeros(len(kinds), np.uint32)
    sizes[of] = n
    of_kind = np.uint16 if len(kinds) <= 1 << 16 else np.uint32
    planes = token.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()
    return np.array([len(token), len(kinds)], np.int64).tobytes() + kinds.tobytes() + sizes.tobytes() + planes + of.astype(of_kind).tobytes()


def _unpack(raw: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = np.frombuffer(raw, np.int64, 2)
    at = 16
    kinds = np.frombuffer(raw, np.int64, k, at)
    at += 8 * k
    sizes = np.frombuffer(raw, np.uint32, k, at)
    at += 4 * k
    bytes_ = np.zeros((n, 8), np.uint8)
    bytes_[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, at).reshape(6, n).T
    at += 6 * n
    of = np.frombuffer(raw, np.uint16 if k <= 1 << 16 else np.uint32, n, at)
    return bytes_.view(">u8").astype(np.uint64).ravel(), kinds[of], sizes[of]


def _postings(shards: int, frequent: np.ndarray):
    """Rows (shard, packed postings) of each block. Frequent shingles go to shards of their own, dealt by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lo, hi, owner, h, size, cls in _blocks(batches):
            # one text of each class is enough
            first = np.zeros(hi - lo, bool)
            first[np.unique(cls, return_index=True)[1]] = True
            take = first[owner]
            owner, token = owner[take], h[take] & ~((np.uint64(1) << _CUT) - np.uint64(1))
            if not len(token):
                continue
            order = np.argsort(token, kind="stable")
            token, own = token[order], owner[order]
            kind, n = cls[own], size[own]
            shard = ((token >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            if len(frequent):
                spot = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
                often = frequent[spot] == token
                dealt = shards + (kind.view(np.uint64) % np.uint64(shards)).astype(np.int64)
                shard = np.where(often, dealt, shard)
                order = np.argsort(shard, kind="stable")
                shard, token, kind, n = shard[order], token[order], kind[order], n[order]
            at = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(at, [*at[1:], len(shard)], strict=True):
                packed = _pack(token[a:b], kind[a:b], n[a:b])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([int(shard[a])], pa.int64()), "packed": pa.array([packed], pa.binary())})

    return run


def _lists(shards: int, frequent: np.ndarray, counts: np.ndarray):
    """The postings of one shard whose list holds two classes or more: (cls, n, posting).

    A posting is one number, the list's length above the token's leading 48 bits, so that numbers sort as lists do: by
    length, up to a bound, and then by token.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_buffer()) for x in table.column("packed")]
        token, cls, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((cls, token))
        token, cls, n = token[order], cls[order], n[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        token, cls, n = token[new], cls[new], n[new]
        if key[0].as_py() >= shards:
            df = counts[np.searchsorted(frequent, token)]
        else:
            at = np.flatnonzero(np.diff(token, prepend=token[0] + np.uint64(1)))
            df = np.repeat(np.diff([*at, len(token)]), np.diff([*at, len(token)]))
        shared = df > 1
        made = pa.table(
            {
                "cls": pa.array(cls[shared], pa.int64()),
                "n": pa.array(n[shared].astype(np.int64)),
                "posting": pa.array((np.minimum(df[shared], _LONGEST).astype(np.int64) << 48) | (token[shared] >> _CUT).astype(np.int64)),
            }
        )
        del token, cls, n, new, order, df
        release()
        return made

    return run


def _token(posting):
    return F.shiftleft(posting.bitwiseAND(F.lit((1 << 48) - 1)), 16)


def least_overlap(n):
    """Least overlap a set of ``n`` needs with any partner."""
    return F.ceil(F.lit(PERCENT) * n / 100)


def least_hits(n_a, n_b):
    """Short lists that two sets must share if they link: the overlap needed, less what the long lists can hold.

    Of two sets, the one whose short lists end first has all its common short lists among the other's, and its long
    ones are one fewer than the overlap that it needs with any partner.
    """
    overlap = lambda n, whole: -(-PERCENT * n // whole)
    return overlap(n_a + n_b, 100 + PERCENT) - max(overlap(n_a, 100), overlap(n_b, 100)) + 1


def heap_merge(lists: list[list[int]]) -> Iterator[tuple[int, int]]:
    """(value, lists that hold it) of sorted lists."""
    last, hits = None, 0
    for value in heapq.merge(*lists):
        if value == last:
            hits += 1
            continue
        if hits:
            yield last, hits
        last, hits = value, 1
    if hits:
        yield last, hits


def probe(long: np.ndarray, other: np.ndarray, have: int, need: int) -> int:
    """Overlap after probing each long list for a candidate, or less than ``need`` as soon as it cannot be reached.

    "Is the candidate in the list of this shingle" is "is this shingle in the candidate's set", which is sorted.
    """
    step = 256
    for lo in range(0, len(long), step):
        if have + len(long) - lo < need:
            return have
        part = long[lo : lo + step]
        spot = np.minimum(np.searchsorted(other, part), len(other) - 1) if len(other) else None
        have += int((other[spot] == part).sum()) if spot is not None else 0
    return have


def few(df: DataFrame, rows: int, name: str) -> DataFrame:
    """``df``, which has at most about ``rows`` rows, written in files of a good size."""
    return materialize(df.coalesce(max(1, -(-rows // ROWS))), name)


def verify(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """The pairs (a, b) that link; ``index`` has each class's shingles, rarest first."""
    left = index.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = index.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("t_a"), batch.column("t_b")
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                mine, other = a[i].values.to_numpy(), np.sort(b[i].values.to_numpy())
                need = -(-PERCENT * int(n_a[i] + n_b[i]) // (100 + PERCENT))
                # the shingles are in order of their list's length: the first are the short lists
                short = mine[: max(0, len(mine) - need + 1)]
                have = probe(short, other, 0, 0)
                ok[i] = have + len(mine) - len(short) >= need and probe(mine[len(short) :], other, have, need) >= need
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(releasing(run), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node reachable.

    Large-star and small-star steps; each round is written, and no node's edges are ever gathered.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rows = now.count()  # no step makes more edges than it was given
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = few(large, rows, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        both = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
        small = linked.select(F.explode(both).alias("e")).select("e.*").filter("a <> b").distinct()
        after = few(small, rows, "small-star")
        # done when every node has one edge, to a node that has none
        up = after.select("a", F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = up.unionByName(after.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1")
        if open_.coalesce(max(1, -(-rows // ROWS))).isEmpty():
            roots = after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        now = after


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("comp", F.col("cls"))
    named = labels.select(F.col("node").alias("cls"), "component")
    return rows.join(named, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")


def _hub_pairs(prefix: DataFrame, labels: DataFrame | None, hub: str) -> DataFrame:
    """One pair per class and short list: with the list's first or last class, where that is of another component."""
    rows = _labelled(prefix, labels)
    pick = F.min_by if hub == "first" else F.max_by
    hubs = rows.groupBy("token").agg(
        pick(F.struct("cls", "comp", "n"), "cls").alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    ).filter("lo < hi").select("token", "hub")
    near = F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * PERCENT
    found = rows.join(hubs, "token").filter((F.col("comp") != F.col("hub.comp")) & near)
    return found.select(F.greatest("cls", "hub.cls").alias("a"), F.least("cls", "hub.cls").alias("b")).distinct()


def occurrences(prefix: DataFrame, labels: DataFrame | None) -> DataFrame:
    """T-occurrence search among classes of different components: pairs (a, b), b < a, to be probed.

    Lists that lie in one component need no search. The others are cut by candidate into parts of about ``LIST``
    entries, so that the merge of a class's lists, which counts each candidate whole, never takes a list at once.
    """
    rows = _labelled(prefix, labels)
    mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("len")).filter("lo < hi")
    mixed = materialize(mixed.select("token", "len"), "mixed")
    longest = mixed.agg(F.max("len")).first()[0]
    if longest is None:
        return prefix.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    parts = -(-longest // LIST)
    rows = rows.join(mixed.select("token"), "token", "left_semi")
    part = F.pmod(F.xxhash64("cls"), F.lit(parts))
    lists = rows.groupBy("token", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("cls", "comp", "n"))).alias("list"))
    asked = rows.select("token", F.col("cls").alias("a"), F.col("comp").alias("comp_a"), F.col("n").alias("n_a"))
    # of a list, a class takes the earlier classes of other components whose size fits
    fits = F.filter(
        "list",
        lambda x: (x["cls"] < F.col("a"))
        & (x["comp"] != F.col("comp_a"))
        & (F.least(x["n"], F.col("n_a")) * 100 >= F.greatest(x["n"], F.col("n_a")) * PERCENT),
    )
    taken = asked.join(lists, "token").select("a", "n_a", "part", fits.alias("list")).filter(F.size("list") > 0)
    pair = F.transform("list", lambda x: F.struct(x["cls"], x["n"]))
    merged = taken.groupBy("a", "part").agg(F.first("n_a").alias("n_a"), F.collect_list(pair).alias("lists"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for mine, n_a, row in zip(batch.column("a").to_pylist(), batch.column("n_a").to_pylist(), batch.column("lists"), strict=True):
                each = [x.values.flatten() for x in row]
                size = {c: n for cls, n in each for c, n in zip(cls.to_pylist(), n.to_pylist(), strict=True)}
                found = [c for c, hits in heap_merge([cls.to_pylist() for cls, _ in each]) if hits >= least_hits(n_a, size[c])]
                a += [mine] * len(found)
                b += found
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return merged.select("a", "n_a", "lists").mapInArrow(releasing(run), "a long, b long")


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets, for each pair of a left and a right one."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    token, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(token), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        # counts below 2^24 are exact
        total += block[left] @ block[right].T
    return total.astype(np.int64)


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, links) of cells of a component, whose rows lie together: documents of other classes that each class links to."""
    held: list[dict] = []

    def count() -> pa.RecordBatch:
        part = np.array([r["part"] for r in held])
        left, right = np.flatnonzero(part == held[0]["first"]), np.flatnonzero(part == held[0]["second"])
        n, docs = np.array([r["n"] for r in held]), np.array([r["docs"] for r in held])
        shared = _overlaps([r["tokens"] for r in held], left, right)
        linked = 100 * shared >= PERCENT * (n[left][:, None] + n[right][None, :] - shared)
        links = np.zeros(len(held), np.int64)
        if held[0]["first"] == held[0]["second"]:
            np.fill_diagonal(linked, False)
            links[left] = linked @ docs[right]
        else:
            links[left] = linked @ docs[right]
            links[right] += docs[left] @ linked
        cls = pa.array([r["cls"] for r in held], pa.int64())
        return pa.RecordBatch.from_arrays([cls, pa.array(links)], ["cls", "links"])

    names = ["component", "first", "second", "part", "cls", "n", "docs"]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in names]
        for row, tokens in zip(zip(*columns, strict=True), batch.column("tokens"), strict=True):
            r = dict(zip(names, row, strict=True), tokens=tokens.values.to_numpy())
            if held and any(r[c] != held[0][c] for c in names[:3]):
                yield count()
                held = []
            held.append(r)
    if held:
        yield count()


def link_counts(index: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(cls, links): the documents of other classes that link to each class of a component.

    ``classes`` has the number of documents of each class. A component is cut into parts of about ``PART`` classes and
    every two parts, or one, are a cell, so that no task holds a component.
    """
    named = labels.select(F.col("node").alias("cls"), "component")
    sizes = named.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    large = maybe_broadcast(materialize(sizes.filter("parts > 1"), "large-components"))
    rows = index.join(named, "cls").join(classes.select("cls", "docs"), "cls").join(large, "component", "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("first", F.least("part", "with")).withColumn("second", F.greatest("part", "with"))
    cell = ["component", "first", "second"]
    dealt = rows.select(*cell, "part", "cls", "n", "docs", "tokens").repartition(*cell).sortWithinPartitions(*cell)
    return dealt.mapInArrow(releasing(_cell_links), "cls long, links long").groupBy("cls").agg(F.sum("links").alias("links"))


def jaccard_components(df: DataFrame, links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of (doc_id, text): texts that share 75 % of their 5-word shingles, chained.

    ``n_links`` counts the other rows that a row links to directly, equal texts among them.

    Texts without words (or null) have no shingle and no link; their component is their own id. Repeated rows each
    get a row. A null id takes part through its text; ``component_id`` is the smallest id that is not null. Other
    columns are ignored; an empty table gives an empty result. ``links=False`` leaves ``n_links`` out.
    """
    spark = df.sparkSession
    docs = narrowed(df, doc_id="bigint", text="string")
    made = materialize(docs.mapInArrow(releasing(_texts), "doc_id long, cls long, n long, token long, seen long"), "shingles")
    texts = made.filter("token is null").select("doc_id", "cls", "n")
    classes = texts.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    n_texts, postings = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // SHARD))
    # at most FREQUENT shingles per average set of texts can be this frequent, however large the table
    floor = max(LEAST_FREQUENT, n_texts // FREQUENT)
    often = made.filter("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= floor).collect()
    token = np.array([r["token"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(token)
    frequent, counts = token[order], np.array([r["seen"] for r in often], np.int64)[order]

    packed = docs.select("text").mapInArrow(releasing(_postings(shards, frequent)), "shard long, packed binary")
    lists = packed.groupBy("shard").applyInArrow(_lists(shards, frequent, counts), "cls long, n long, posting long")
    index = lists.groupBy("cls").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("posting")).alias("by"))
    index = index.filter(F.size("by") >= least_overlap(F.col("n")))
    index = materialize(index.select("cls", "n", F.transform("by", _token).alias("tokens")), "index")
    # the short lists: any partner occurs in one of them
    short = F.slice("tokens", 1, (F.size("tokens") - least_overlap(F.col("n")) + 1).cast("int"))
    prefix = index.select("cls", "n", F.explode(short).alias("token"))
    shared = prefix.groupBy("token").count().filter("count > 1").select("token")
    prefix = materialize(prefix.join(shared, "token", "left_semi"), "prefix")
    rows = prefix.count()

    labels = None
    for search in ("first", "last", "all"):
        pairs = occurrences(prefix, labels).distinct() if search == "all" else _hub_pairs(prefix, labels, search)
        found = verify(few(pairs, rows, "pairs"), index)
        if labels is not None:
            found = found.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = few(components(found), rows, "labels")

    joined = classes.join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
    if links:
        joined = joined.join(link_counts(index, classes, labels), "cls", "left").withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("docs") - 1)
    joined = joined.withColumn("component", F.coalesce("component", "cls"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = ["n_links"] if links else []
    named = materialize(joined.join(least, "component").select("cls", "component_id", *counts), "classes")
    out = texts.join(named, "cls", "left")
    has = F.col("n") > 0
    own = F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), own, *[F.when(has, F.col(c)).otherwise(F.lit(0)).alias(c) for c in counts])


def keep_first(df: DataFrame) -> DataFrame:
    """The row of ``df`` with the smallest id of each component; of several with that id one stays.

    Rows are compared by their texts, whatever their ids: of two different texts with one id both stay. Rows without an
    id always stay. Of texts without words, which have no links, those that repeat both id and text go. Text is not
    shuffled where the rows that go are few enough to be sent to all tasks. A null text has no words; an empty table gives
    an empty one; columns of any name, also of the names used here, come back as they are.
    """
    rows, key = with_rows(df, "documents")
    # components of rows, not of ids
    found = jaccard_components(narrowed(rows, **{key: "bigint", "text": "string"}).withColumnRenamed(key, "doc_id"), links=False)
    found = found.select(F.col("doc_id").alias(key), "n_shingles", "component_id")
    ids = rows.filter("doc_id is not null").select(key, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    # a group of rows is a component, or the texts without words that share an id and a text; all in plain numbers
    linked = F.col("n_shingles") > 0
    one, two = F.when(linked, F.col("component_id")).otherwise(F.col("_id")), F.when(linked, F.lit(0)).otherwise(F.col("_hash"))
    group = ["_linked", "_one", "_two"]
    named = found.join(ids, key).select(key, "_id", linked.alias("_linked"), one.alias("_one"), two.alias("_two"))
    named = materialize(named, "components")
    # the least id, and of its rows the first
    least = named.groupBy(*group).agg(F.min("_id").alias("_id"))
    firsts = named.join(least, [*group, "_id"]).groupBy(*group).agg(F.min(key).alias(key)).select(key)
    gone = materialize(named.join(firsts, key, "left_anti").select(key), "copies")
    return rows.join(maybe_broadcast(gone), key, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
