"""How far the sources of a language differ, term by term, priced from joint tables of count levels.

How it runs:

1. tasks count terms per (lang, source) of many documents at once and send on partial counts;
2. a term that enough documents of a language hold becomes one row with its counts by source. Rows are put in order of
   total count, so that terms of a block have few levels each, and cut into blocks of ``TERMS`` terms;
3. a block is an indicator matrix: a row per term, a column per (source, count that occurs there), zero counts too. Its
   transpose times itself, tile by tile, holds for every pair of sources how many terms have which pair of counts. Products
   of zeros and ones are exact. A term's price follows from its two counts only, so each cell is priced once;
4. prices are added by pair of sources. Only a block's terms, and the list of sources of one language, meet in a task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import buffers, narrowed
from docspark.runtime import materialize, maybe_broadcast, with_positions

#: Documents of its language that a kept term is in.
LEAST_DOCS = 10
TOP = 10
ONE = 1_000_000_000
#: Terms per block; columns per tile of a product; distinct terms that a task holds before it sends them on.
TERMS = 128
TILE = 2048
HELD = 200_000
#: Bytes of a text split at a time.
PIECE = 1 << 20

#: A term is a run of ASCII letters and of bytes of other characters.
_LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time."""
    for lo, hi in _pieces(text):
        yield text[lo:hi].translate(_LETTERS).split()


def _pieces(text: bytes) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(text):
        hi = lo + PIECE
        while hi < len(text) and _LETTERS[text[hi]] != 0x20:
            hi += 1
        yield lo, min(hi, len(text))
        lo = hi


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (lang, source, term, n, docs); a row without a term says that the group exists."""
    names = ["lang", "source", "term", "n", "docs"]
    n, docs, held = defaultdict(Counter), defaultdict(Counter), 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in n.items():
            of, seen = docs[lang, source], [*found]
            for lo in range(0, len(seen) + 1, 50_000):
                some = seen[lo : lo + 50_000]
                head = [None] if lo == 0 else []
                size = len(some) + len(head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * size, pa.string()),
                        pa.array([source] * size, pa.string()),
                        pa.array(head + some, pa.binary()).cast(pa.string()),
                        pa.array([0] * len(head) + [found[t] for t in some], pa.int64()),
                        pa.array([0] * len(head) + [of[t] for t in some], pa.int64()),
                    ],
                    names,
                )

    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        body = data.tobytes()
        for i, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)):
            group, of = n[key], docs[key]
            before, own = len(group), set()
            for some in terms(body[offsets[i] : offsets[i + 1]]):
                group.update(some)
                own.update(some)
            of.update(own)
            held += len(group) - before
            if held > HELD:
                yield from rows()
                n, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    yield from rows()


def counted(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a null term stands once for each group."""
    docs = narrowed(df, text="string", lang="string", source="string")
    docs = docs.select("text", *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
    found = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The smoothed share of each count in billionths, plus one."""
    return np.array([1 + ONE * (int(c) + 2) // (total + 2 * kept) for c in counts], np.int64)


def joint(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The joint tables of a block, ``counts`` being a row per term and a column per source.

    Yields (source a, its count, source b, its count, terms that have both) for all cells that are not zero, a <= b.
    """
    n_terms, n_sources = counts.shape
    levels, columns, owner, width = [], [], [], 0
    for g in range(n_sources):
        level, column = np.unique(counts[:, g], return_inverse=True)
        levels.append(level)
        columns.append(column.ravel() + width)
        owner.append(np.full(len(level), g))
        width += len(level)
    levels, owner = np.concatenate(levels), np.concatenate(owner)

    def indicators(lo: int, hi: int) -> np.ndarray:
        tile = np.zeros((n_terms, hi - lo), np.float32)
        for g in range(owner[lo], owner[hi - 1] + 1):
            inside = (columns[g] >= lo) & (columns[g] < hi)
            tile[np.flatnonzero(inside), columns[g][inside] - lo] = 1
        return tile

    for lo_a in range(0, width, TILE):
        hi_a = min(lo_a + TILE, width)
        left = indicators(lo_a, hi_a).T
        for lo_b in range(lo_a, width, TILE):
            hi_b = min(lo_b + TILE, width)
            cells = left @ indicators(lo_b, hi_b)
            i, j = np.nonzero(cells)
            a, b = i + lo_a, j + lo_b
            once = a <= b
            i, j, a, b = i[once], j[once], a[once], b[once]
            yield owner[a], levels[a], owner[b], levels[b], cells[i, j].astype(np.int64)


def _price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value), a before b, of each block of terms."""
    for batch in batches:
        for row in batch.to_pylist():
            sources = [m["source"] for m in row["members"]]
            at = {s: k for k, s in enumerate(sources)}
            counts = np.zeros((len(row["terms"]), len(sources)), np.int64)
            for t, by in enumerate(row["terms"]):
                for one in by:
                    counts[t, at[one["source"]]] = one["n"]
            total = [m["total"] for m in row["members"]]
            # a level's share, once per source
            tables = [np.unique(counts[:, g]) for g in range(len(sources))]
            priced = [shares(level, total[g], row["kept"]) for g, level in enumerate(tables)]
            start = np.cumsum([0, *map(len, tables)])
            share, flat = np.concatenate(priced), np.concatenate(tables)
            value = np.zeros((len(sources), len(sources)), np.int64)
            code = np.repeat(np.arange(len(sources)), np.diff(start)) * (int(flat.max()) + 1) + flat
            for a, x, b, y, cells in joint(counts):
                p = share[np.searchsorted(code, a * (int(flat.max()) + 1) + x)]
                q = share[np.searchsorted(code, b * (int(flat.max()) + 1) + y)]
                np.add.at(value, (a, b), cells * ((p - q) * (p - q) // (p + q)))
            a, b = np.triu_indices(len(sources), 1)
            names = pa.array(sources, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value[a, b], pa.int64())],
                ["lang", "a", "b", "value"],
            )


def _share(n: str, total: str, kept: str) -> str:
    wide = "cast({} as decimal(20,0))"
    return f"1 + {wide.format(ONE)} * ({wide.format(n)} + 2) div ({wide.format(total)} + 2 * {wide.format(kept)})"


def audit(df: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of (text, lang, source): the divergence of sources, and their own terms.

    Part ``pair`` ranks, for each group, the other sources of its language by the sum over all kept terms; part ``term`` the
    ten kept terms that mark it most against its language. Null text, lang and source count as ''. A language without kept
    terms has pairs of value 0; a single source has no pair; groups without terms take part with counts of 0. Repeated rows
    count each time. Ties are ranked by item. An empty table gives an empty result. Other columns are ignored.
    """
    counts = materialize(counted(df), "term-counts")
    by = F.collect_list(F.struct("source", "n")).alias("by")
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(by, F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = materialize(kept.filter(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept-terms")
    each = kept.select("lang", "term", "total", F.explode("by").alias("o")).select("lang", "term", "total", "o.source", "o.n")
    groups = counts.filter("term is null").select("lang", "source").join(each.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left")
    groups = materialize(groups.select("lang", "source", F.coalesce("own", F.lit(0)).alias("own")), "groups")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("whole"))

    # pairs: blocks of terms, priced where they lie
    members = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.col("own").alias("total")))).alias("members"))
    members = materialize(members.join(langs, "lang").select("lang", "kept", "members"), "members")
    placed = with_positions(kept, ["total", "term"], ["lang"])
    block = F.expr(f"(pos - 1) div {TERMS}").alias("block")
    blocks = placed.groupBy("lang", block).agg(F.collect_list("by").alias("terms")).join(maybe_broadcast(members), "lang")
    priced = blocks.select("lang", "terms", "kept", "members").mapInArrow(_price, "lang string, a string, b string, value long")
    priced = materialize(priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "prices")
    one, other = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    pairs = one.join(other, "lang").filter("source <> item").withColumn("a", F.least("source", "item")).withColumn("b", F.greatest("source", "item"))
    pairs = pairs.join(priced, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    # terms: each group's counts against its language's
    marked = each.join(maybe_broadcast(groups), ["lang", "source"]).join(maybe_broadcast(langs), "lang")
    marked = marked.withColumn("p", F.expr(_share("n", "own", "kept"))).withColumn("q", F.expr(_share("total", "whole", "kept"))).filter("p > q")
    marked = marked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    marked = marked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return pairs.unionByName(marked)


ORACLE = r"""
with d as materialized (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
c as materialized (select lang, source, term, count(*) as n, count(distinct id) as docs from w group by all),
k as materialized (select lang, term, sum(n) as total from c group by all having sum(docs) >= 10),
v as materialized (select lang, count(term) as kept, coalesce(sum(total), 0) as total from (select distinct lang from d) left join k using (lang) group by lang),
g as materialized (select d.lang, d.source, coalesce(sum(n), 0) as total from (select distinct lang, source from d) d
  left join (select c.* from c join k using (lang, term)) c on c.lang = d.lang and c.source = d.source group by all),
p as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v.kept) as p,
    1 + (1000000000::hugeint * (k.total + 2)) // (v.total + 2 * v.kept) as q
  from g join v using (lang) join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term where a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
marks as (select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value from p where n > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from (select * from pairs union all select * from marks))
select * from ranked where part = 'pair' or rank <= 10
"""
