"""Queries of this subpackage: each key runs on Spark; where SQL can say the same, it carries that SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from docspark.runtime import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"query {key} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
