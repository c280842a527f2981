"""Positions, batches and balanced placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.runtime import with_positions

BATCH = 100


def slice_range(df: DataFrame, start: int, end: int | None, order: list[str]) -> DataFrame:
    """Rows at positions start..end (1-based, inclusive), with their position."""
    ranked = with_positions(df, order)
    return ranked.where((F.col("pos") >= start) & (F.lit(True) if end is None else F.col("pos") <= end))


def bucket_by_uri(uri: Column, n: int) -> Column:
    """Target 0..n-1 by URI hash."""
    return F.pmod(F.xxhash64(uri), F.lit(n)).cast("int")


def spread_by_uri(docs: DataFrame, n: int) -> DataFrame:
    return docs.repartition(n, "uri")


def batch_index(docs: DataFrame, order: list[str], batch: int = BATCH) -> DataFrame:
    """Number of the batch each document travels in, from 0."""
    ranked = with_positions(docs, order, name="_pos")
    return ranked.withColumn("batch", F.floor((F.col("_pos") - 1) / batch).cast("bigint")).drop("_pos")


def round_robin(batch: Column, n: int) -> Column:
    """Targets rotate after each batch."""
    return F.pmod(batch, F.lit(n)).cast("int")


def balanced_target(batch_no: Column, loads: list[int], batch: int = BATCH) -> Column:
    """Target of each batch when every batch goes to the least loaded one (the lowest number on ties).

    Target t takes batches at loads ``loads[t] + k * batch``; batches fill these slots in ascending order. Cut
    the loads into intervals of one batch: every target already reached has one slot in each interval, always
    in the same order. So between two targets joining, the choice is a plain rotation: one segment per joining
    target, found by arithmetic and not by replaying the batches.
    """
    low = min(loads)
    cycle = sorted(range(len(loads)), key=lambda t: ((loads[t] - low) % batch, t))
    level = [(load - low) // batch for load in loads]
    segments, at = [], 0
    levels = sorted(set(level))
    for here, nxt in zip(levels, [*levels[1:], None]):
        active = [t for t in cycle if level[t] <= here]
        segments.append((at, active))
        if nxt is not None:
            at += (nxt - here) * len(active)
    out = F.lit(None).cast("int")
    for begin, active in segments:
        turn = F.pmod(batch_no - begin, F.lit(len(active))).cast("int")
        out = F.when(batch_no >= begin, F.get(F.array(*[F.lit(t) for t in active]), turn)).otherwise(out)
    return out


def balance_assign(docs: DataFrame, loads: list[int], order: list[str], batch: int = BATCH) -> DataFrame:
    """Assign each batch of documents to the least loaded target, loads growing by a batch each time."""
    return batch_index(docs, order, batch).withColumn("target", balanced_target(F.col("batch"), loads, batch))
