"""Preference pairs of conversations: one prompt, two completions, and the parts that count for a loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.common import narrowed
from docspark.runtime import materialize, with_positions

#: Role whose text a loss counts.
LEARNED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """A turn as it stands in a prompt or a completion."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def pairs_of(turns: DataFrame) -> DataFrame:
    """Pairs of conversations, neighbours by their first turn and id: pair_id, chosen_id, rejected_id.

    The order is made by a range sort, so that a first turn which a third of all conversations share spreads over the
    tasks. The first of two neighbours is the chosen one; the last of an odd number has no rejected one.
    """
    first = turns.filter("idx = 0").select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = with_positions(first, ["text", "role", "conv_id"]).select("conv_id", "pos")
    pair, second = F.floor((F.col("pos") - 1) / 2).cast("bigint"), (F.col("pos") - 1) % 2 == 1
    return placed.groupBy(pair.alias("pair_id")).agg(
        F.max(F.when(~second, F.col("conv_id"))).alias("chosen_id"), F.max(F.when(second, F.col("conv_id"))).alias("rejected_id")
    )


def indexed(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (number of the turn from 0), role, text. Turns are in order of turn, role and text, nulls first.

    Rows without a conversation are left out: they belong to none. Positions come from a range sort, not from a
    window, so that a conversation may be of any length.
    """
    rows = narrowed(conversations, conv_id="bigint", turn="bigint", role="string", text="string").filter("conv_id is not null")
    placed = with_positions(rows, ["turn", "role", "text"], ["conv_id"], "idx")
    return materialize(placed.select("conv_id", (F.col("idx") - 1).alias("idx"), "role", "text"), "turns")


def preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """A row per rendered turn: pair_id, part, idx, conv_id, rendered, start, length, loss.

    ``part`` is "prompt" for the turns that both conversations begin with, which stand there once, and "chosen" or
    "rejected" for those after. Two turns are the same if role and text are; null counts as empty. ``start`` is the
    turn's offset in its part in code points. ``loss`` tells whether the text counts: it is true for the learned role
    in completions, false for everything else. A chosen one without a rejected one has an empty prompt. Rows, not whole
    conversations, are moved and returned; ``assembled`` puts them together.
    """
    sides = [(c, F.col(f"{c}_id")) for c in ("chosen", "rejected")]
    side = F.explode(F.array(*[F.struct(F.lit(n).alias("side"), i.alias("conv_id")) for n, i in sides])).alias("s")
    members = pairs.select("pair_id", F.col("rejected_id").isNull().alias("alone"), side).select("pair_id", "alone", "s.*")
    rows = turns.join(members.filter("conv_id is not null"), "conv_id")
    rows = materialize(rows.withColumn("same", F.xxhash64(F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))), "sides")
    # a place in the pair at which the two sides do not have the same turn
    place = rows.groupBy("pair_id", "idx").agg(F.count(F.lit(1)).alias("n"), F.min("same").alias("lo"), F.max("same").alias("hi"))
    differs = place.filter("n <> 2 or lo <> hi").groupBy("pair_id").agg(F.min("idx").alias("common"))
    rows = rows.join(differs, "pair_id", "left")
    shared = ~F.col("alone") & (F.col("idx") < F.coalesce(F.col("common"), F.col("idx") + 1))
    rows = rows.filter(~shared | (F.col("side") == "chosen"))
    out = rows.select(
        "pair_id",
        F.when(shared, "prompt").otherwise(F.col("side")).alias("part"),
        "idx",
        "conv_id",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
        F.coalesce(~shared & (F.col("role") == LEARNED), F.lit(False)).alias("loss"),
    ).withColumn("length", F.char_length("rendered").cast("bigint"))
    out = with_positions(out, ["idx"], ["pair_id", "part"], "start", "length").withColumn("start", F.col("start") - 1)
    return out.select("pair_id", "part", "idx", "conv_id", "rendered", "start", "length", "loss")


def assembled(segments: DataFrame) -> DataFrame:
    """A row per pair: pair_id, prompt, chosen, rejected, chosen_loss, rejected_loss ((start, end) of what counts).

    Here a pair's turns meet in one row; use it where conversations are short enough for that.
    """
    rows = segments.groupBy("pair_id", "part").agg(F.sort_array(F.collect_list(F.struct("idx", "rendered", "start", "length", "loss"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: x["rendered"]), "")
    spans = F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["length"]).alias("end")))
    rows = rows.select("pair_id", "part", text.alias("text"), spans.alias("spans"))
    pick = lambda part, what: F.max(F.when(F.col("part") == part, F.col(what)))
    return rows.groupBy("pair_id").agg(
        F.coalesce(pick("prompt", "text"), F.lit("")).alias("prompt"),
        F.coalesce(pick("chosen", "text"), F.lit("")).alias("chosen"),
        F.coalesce(pick("rejected", "text"), F.lit("")).alias("rejected"),
        pick("chosen", "spans").alias("chosen_loss"),
        pick("rejected", "spans").alias("rejected_loss"),
    )


def neighbour_preferences(conversations: DataFrame) -> DataFrame:
    """Preference segments of a table of conversations (conv_id, turn, role, text), paired by their first turns."""
    turns = indexed(conversations)
    return preferences(turns, pairs_of(turns))


ORACLE = f"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as idx,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
placed as (select conv_id, row_number() over (order by text, role, conv_id) - 1 as pos from t where idx = 0),
sides as (
  select t.*, pos // 2 as pair_id, case when pos % 2 = 0 then 'chosen' else 'rejected' end as side,
         pos % 2 = 0 and pos = (select max(pos) from placed) as alone
  from t join placed using (conv_id)),
common as (
  select pair_id, min(idx) filter (where n <> 2 or kinds <> 1) as common
  from (select pair_id, idx, count(*) as n, count(distinct (role, text)) as kinds from sides group by 1, 2) group by 1),
parts as (
  select pair_id, case when not alone and idx < coalesce(common, idx + 1) then 'prompt' else side end as part, idx, conv_id, side,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as rendered, role
  from sides join common using (pair_id))
select pair_id, part, idx, conv_id, rendered,
       (sum(length(rendered)) over (partition by pair_id, part order by idx))::bigint - length(rendered) as start,
       length(rendered) as length, part <> 'prompt' and role = '{LEARNED}' as loss
from parts where part <> 'prompt' or side = 'chosen'
"""
