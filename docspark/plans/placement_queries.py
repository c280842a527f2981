"""Positions, batches and placement over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docspark.operators import placement as P
from docspark.plans.catalog import query
from docspark.plans.derive import TEXT_DOCS, table, text_docs
from docspark.runtime import work_path
from docspark.sinks.store import write_partition


@query(
    "slice_range",
    f"select uri, pos from (select uri, row_number() over (order by uri) as pos from {TEXT_DOCS}) where pos between 101 and 700",
)
def q_slice_range(spark, sf):
    return P.slice_range(text_docs(spark, sf).select("uri"), 101, 700, ["uri"])


@query("bucket_by_uri", "select count(*) as docs, 16::bigint as buckets, true as even from documents")
def q_bucket_by_uri(spark, sf):
    """All documents are placed, every target is used, none holds twice its share."""
    placed = text_docs(spark, sf).select(P.bucket_by_uri(F.col("uri"), 16).alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("docs"), F.count(F.lit(1)).alias("buckets"),
        (F.max("n") < F.sum("n") / 16 * 2).alias("even"),
    )


_LOADS = [2500, 0, 730, 1210]
_BALANCED = """with slots as (select t, l + k * 100 as load from (select unnest([0, 1, 2, 3]) as t, unnest([2500, 0, 730, 1210]) as l),
 range(0, (select count(*) // 100 + 2 from orders)) r(k)),
 ranked as (select t, row_number() over (order by load, t) - 1 as batch from slots),
 docs as (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 100 as batch from orders)
 select o_orderkey, docs.batch::bigint as batch, t::int as target from docs join ranked using (batch)"""


@query("balance_assign", _BALANCED)
def q_balance_assign(spark, sf):
    return P.balance_assign(table(spark, sf, "orders").select("o_orderkey"), _LOADS, ["o_orderkey"])


@query(
    "round_robin",
    "select o_orderkey, (((row_number() over (order by o_orderkey) - 1) // 100) % 5)::int as target from orders",
)
def q_round_robin(spark, sf):
    batched = P.batch_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return batched.select("o_orderkey", P.round_robin(F.col("batch"), 5).alias("target"))


@query(
    "target_partition",
    "select doc_id, lang, case when lang = 'en' then 'second' else 'first' end as target_partition from documents",
)
def q_target_partition(spark, sf):
    """Loads of two partitions; the English one is loaded again into its own, which it replaces."""
    path = work_path(spark, "partitioned")
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    write_partition(docs.where("lang <> 'en'"), path, "first")
    write_partition(docs, path, "second")
    write_partition(docs.where("lang = 'en'"), path, "second")
    return spark.read.parquet(path)
