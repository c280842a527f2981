"""Run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docspark.runtime import maybe_broadcast


def load_report(docs: DataFrame, estimated: int | None = None, failed: DataFrame | None = None) -> DataFrame:
    """The five counters of a load, one row: estimated input, input, output, committed, failed.

    ``failed`` holds documents (uri) that were sent but not committed.
    """
    ok = F.col("skip_reason").isNull()
    if failed is not None:
        docs = docs.join(maybe_broadcast(failed.select("uri").distinct().withColumn("_failed", F.lit(True))), "uri", "left")
    bad = F.coalesce(F.col("_failed"), F.lit(False)) if failed is not None else F.lit(False)
    est = F.count(F.lit(1)) if estimated is None else F.lit(estimated).cast("bigint")
    return docs.agg(
        est.alias("estimated_input"),
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(ok).alias("output_records"),
        F.count_if(ok & ~bad).alias("committed_records"),
        F.count_if(ok & bad).alias("failed_records"),
    )


def observe_load(docs: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Count input and output while the documents are written, without a second pass."""
    seen = Observation(name)
    return (
        docs.observe(
            seen,
            F.count(F.lit(1)).alias("input_records"),
            F.count_if(F.col("skip_reason").isNull()).alias("output_records"),
        ),
        seen,
    )
