"""Scans of stores with large later loads."""

import pytest
from pyspark.sql import functions as F

from docspark.plans.structure_queries import q_scan_as_of_after_upsert
from docspark.schema import to_docs
from docspark.sinks import store


def docs(spark, lo, hi, text, step=1):
    rows = spark.range(lo, hi, step).select(F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("uri"), F.lit(text).alias("text"))
    return to_docs(rows, content_type=F.lit("TEXT"))


@pytest.fixture
def path(spark, tmp_path):
    where = str(tmp_path / "store")
    store.write_store(docs(spark, 0, 20_000, "old"), where)
    store.upsert_docs(docs(spark, 0, 20_000, "new", 40), where)
    store.upsert_docs(docs(spark, 19_800, 20_300, "newest"), where)
    return where


def test_same_documents_with_filters(spark, path):
    few = {(r["uri"], r["text"]) for r in store.scan_docs(spark, path).collect()}
    many = store.scan_docs(spark, path, broadcast_rows=10)
    got = [(r["uri"], r["text"]) for r in many.collect()]
    assert len(got) == len(few) == 20_300 and set(got) == few
    assert sum(t == "newest" for _, t in got) == 500 and sum(t == "new" for _, t in got) == 495


def test_only_what_may_be_replaced_is_shuffled(spark, path):
    loads = store._state(spark, path)[1]
    rows, later = store._read(spark, path, loads), store._read(spark, path, loads[1:])
    bits = store._filter_bits(later.count(), store.store_buckets(spark, path))
    marks = store._marks(later.select("buckets", "bucket", "uri"), bits)
    tested = rows.join(marks, ["buckets", "bucket"], "left").withColumn("maybe", store._marked(bits))
    count = {(r["load"], r["maybe"]): r["count"] for r in tested.groupBy("load", "maybe").count().collect()}
    # all rows of later loads, the rows that they replace, and few others
    assert count[1, True] == 500 and count[2, True] == 500 and (1, False) not in count
    assert 700 <= count[0, True] <= 700 + 200
    plan = store.scan_docs(spark, path, broadcast_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") <= 1


def test_filters_are_of_bounded_size():
    for n, buckets in ((10, 8), (10**6, 8), (10**12, 8), (10**9, 5000)):
        assert 8 <= store._filter_bits(n, buckets) // 8 and store._filter_bits(n, buckets) // 8 * buckets <= store.BROADCAST_BYTES


def test_uris_of_later_loads_do_not_go_through_the_driver(spark, path):
    """Files of URIs are small beside their rows: where there are many, only filters are sent to the tasks."""
    plan = store.scan_docs(spark, path, broadcast_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2


def test_versions_are_joined_by_key(spark, sf):
    both = q_scan_as_of_after_upsert(spark, sf)
    top = both._jdf.queryExecution().optimizedPlan().toString().splitlines()[1]
    assert "Join Inner" in top and "strategy=merge" in top
