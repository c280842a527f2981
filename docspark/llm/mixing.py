"""Mix sources to target weights by whole blocks, apportioned by highest quotients. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import WORD, fresh, narrowed
from docspark.runtime import materialize, maybe_broadcast, with_positions, with_rows

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Size of the mix in sizes of the input, and of a source's target in sizes of the source.
SHARE, MOST = 1.5, 2
#: Words per block. A block is an interval of a shard's words, never a row, so that small ones cost nothing.
BLOCK = 8
#: Shards of a source: the first hex digit of a seeded hash of the id.
SHARDS = 16
SEED = 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Level:
    """Words that a unit of weight gets, as the quotient of ``rest`` and ``weights`` of the sources below their cap."""

    rest: float
    weights: int

    def share(self) -> Column:
        return F.col("weight") * F.lit(self.rest) / F.lit(float(self.weights))

    def target(self) -> Column:
        cap = F.lit(float(MOST)) * F.col("source_size")
        return F.when(self.share() > cap, cap).otherwise(self.share())


def level(sources: DataFrame) -> Level:
    """Share out the mix by weight; what exceeds a source's cap is shared out again until none exceeds it.

    Each round is one aggregation that returns three numbers; the level only rises, so a capped source stays capped.
    """
    total, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    now, capped = Level(SHARE * total, max(weights, 1)), 0
    while total:
        above = now.share() > F.lit(float(MOST)) * F.col("source_size")
        n, used, out = sources.filter(above).agg(
            F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
        ).first()
        if n == capped:
            break
        now, capped = Level(SHARE * total - MOST * used, max(weights - out, 1)), n
    return now


def quotas(shards: DataFrame) -> DataFrame:
    """Blocks of each (source, shard, shard_size, source_size, target): columns source, shard, shard_size, quota.

    Sainte-Lague: the k-th block of a source goes at the quotient target / (2k - 1). All quotients of at least half a
    block are served, which gives a source its target in blocks, rounded. Inside a source its blocks go to the shards
    in the same way, by highest quotient. A shard's number cannot be further from its proportional share than half
    the number of shards, so only the quotients in that range compete.
    """
    blocks = F.floor(F.col("target") / BLOCK + 0.5)
    reach = SHARDS // 2 + 1
    even = F.when(F.col("source_size") > 0, blocks * F.col("shard_size") / F.col("source_size")).otherwise(0.0)
    base = shards.withColumn("blocks", blocks).withColumn("base", F.greatest(F.floor(even) - reach, F.lit(0)))
    by_source = Window.partitionBy("source")
    seats = base.withColumn("left", F.col("blocks") - F.sum("base").over(by_source))
    rival = seats.withColumn("k", F.explode(F.sequence(F.col("base") + 1, F.col("base") + 2 * reach + 2)))
    quotient = F.col("shard_size") / (2 * F.col("k") - 1)
    rank = F.row_number().over(by_source.orderBy(quotient.desc(), "shard", "k"))
    won = rival.withColumn("won", (rank <= F.col("left")).cast("bigint"))
    return won.groupBy("source", "shard", "shard_size").agg((F.first("base") + F.sum("won")).alias("quota"))


def mix(df: DataFrame, row: str | None = None) -> DataFrame:
    """What the mix takes of each (doc_id, text, source): doc_id, source, size, source_size, target, first, second.

    ``first`` and ``second`` are the words taken in the first and the second pass over a shard, both from the start of
    the document; no third pass exists. A shard's documents stand in the order of a seeded hash of their ids and are
    read as one run of words, cut into blocks; its quota takes blocks from the front, which the hash made a random
    choice. So only the last document of a pass is cut. Reruns agree, on any partitioning.

    A null text has size 0; a null source is a source, the last; a null id is an id. Rows that repeat are
    interchangeable. An empty table, or one without words, takes nothing. ``row`` names a column that numbers the
    rows; it comes back as ``row``, and rows that share id and size then stand in the order of their texts.
    """
    docs = narrowed(df, doc_id="bigint", source="string", text="string", **({row: "bigint"} if row else {}))
    own = [F.col(row).alias("row"), F.xxhash64("text").alias("hash")] if row else []
    named = ["hash", "row"] if row else []
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{SEED}")).cast("binary"))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"), *own)
    sized = materialize(sized.withColumn("shard", F.substring("key", 1, 1)), "sizes")

    shards = materialize(sized.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")), "shards")
    sources = shards.groupBy("source").agg(F.sum("shard_size").alias("source_size")).withColumn("last", F.col("source").isNull())
    place = F.pmod(F.col("pos") - 1, F.lit(len(WEIGHTS))).cast("int") + 1
    ranked = with_positions(sources, ["last", "source"]).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place))
    ranked = materialize(ranked.select("source", "source_size", "weight"), "sources")
    targets = ranked.withColumn("target", level(ranked).target()).drop("weight")

    # a source at its cap gives all it has, in both passes
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    known = shards.alias("a").join(maybe_broadcast(targets).alias("b"), same).select("a.*", "source_size", "target")
    given = known.alias("a").join(quotas(known).drop("shard_size").alias("b"), same & (F.col("a.shard") == F.col("b.shard")))
    full = F.when(F.col("target") >= MOST * F.col("source_size"), MOST * F.col("shard_size"))
    given = materialize(given.select("a.*", full.otherwise(F.col("quota") * BLOCK).alias("words")), "quotas")

    placed = with_positions(sized, ["key", "doc_id", "size", *named], ["source", "shard"], "at", "size")
    at = F.col("at") - 1
    part = lambda words: F.least(F.col("size"), F.greatest(words - at, F.lit(0)))
    out = placed.alias("a").join(maybe_broadcast(given).alias("b"), same & (F.col("a.shard") == F.col("b.shard")))
    return out.select(
        "doc_id", "a.source", "size", "source_size", "target", part(F.col("words")).alias("first"), part(F.col("words") - F.col("shard_size")).alias("second"),
        *named[1:],
    )


def taken(df: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and ``taken``, the words of both passes."""
    return mix(df).select("doc_id", "size", "source_size", "target", (F.col("first") + F.col("second")).alias("taken"))


def mixed(df: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row for each pass that takes a document, ``text`` cut where a pass ends.

    A cut keeps the white space between the words it keeps. Every row is taken and cut on its own, also those that share
    an id or have none; documents without words, or with a null text, are not in a mix of words. An empty table gives an
    empty mix; columns of any name, also of the names used here, come back.
    """
    docs, row = with_rows(df, "documents")
    size, take = fresh(docs, "_size", "_take")
    passes = F.filter(F.array("first", "second"), lambda n: n > 0)
    found = mix(docs, row).select(F.col("row").alias(row), F.col("size").alias(size), F.explode(passes).alias(take))
    rows = docs.join(found, row)
    words = F.regexp_extract_all("text", F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1))
    cut = F.array_join(F.slice(words, 1, F.col(take).cast("int")), "")
    text = F.when(F.col(take) < F.col(size), cut).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in df.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(df.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])


ORACLE = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, 'null') || ':{SEED}') as key
  from documents),
shards as (select source, key[1] as shard, sum(size)::bigint as n from d group by 1, 2),
sources as (
  select source, sum(n)::bigint as n, {MOST}.0 * sum(n)::bigint as cap,
         [{", ".join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as w
  from shards group by source),
filled as (
  select *, row_number() over o as j, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as used,
         coalesce(sum(w) over (o rows between unbounded preceding and 1 preceding), 0) as out
  from sources window o as (order by cap / w, w, source nulls last)),
level as (
  select {SHARE} * (select sum(n) from sources)::bigint - used::double as rest, (select sum(w) from sources) - out as weights
  from filled
  where w * ({SHARE} * (select sum(n) from sources)::bigint - used::double) / ((select sum(w) from sources) - out) <= cap
  order by j limit 1),
targets as (
  select source, n, case when w * rest / weights > cap then cap::double else (w * rest::double / weights::double) end as target
  from sources, level),
known as (
  select s.source, s.shard, s.n as shard_size, t.n as source_size, t.target, floor(t.target / {BLOCK} + 0.5) as blocks
  from shards s join targets t on s.source is not distinct from t.source),
based as (
  select *, greatest(floor(case when source_size > 0 then blocks * shard_size / source_size else 0 end) - {SHARDS // 2 + 1}, 0)::bigint as base
  from known),
rivals as (
  select *, unnest(range(base + 1, base + {2 * (SHARDS // 2 + 1) + 3})) as k
  from (select *, blocks - sum(base) over (partition by source) as seats from based)),
ranked as (
  select *, row_number() over (partition by source order by shard_size / (2 * k - 1) desc, shard, k) <= seats as won from rivals),
given as (
  select source, shard, shard_size, source_size, target,
         case when target >= {MOST} * source_size then {MOST} * shard_size else (base + count(*) filter (where won)) * {BLOCK} end as words
  from ranked group by source, shard, shard_size, source_size, target, base),
placed as (
  select doc_id, source, key[1] as shard, size,
         (sum(size) over (partition by source, key[1] order by key, doc_id, size rows unbounded preceding))::bigint - size as first_word
  from d)
select doc_id, size, source_size, target,
       (least(size, greatest(words - first_word, 0)) + least(size, greatest(words - shard_size - first_word, 0)))::bigint as taken
from placed p join given g on p.source is not distinct from g.source and p.shard = g.shard
"""
