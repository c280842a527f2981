"""Run a query and its SQL over the same tables and compare the rows.

``python -m tests.compare [--sf DIR] [KEY ...]`` checks keys (default: all) and prints one line each.
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", round(v, 9))
    if isinstance(v, bytearray):
        return bytes(v)
    if isinstance(v, list):
        return tuple(map(_cell, v))
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


_KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "binary": "BLOB"}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if kind in _KINDS and _KINDS[kind] != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    got = rows_of(df.columns, df.collect())
    if got == want:
        return None
    extra, lost = got - want, want - got
    return (
        f"{sum(got.values())} rows vs {sum(want.values())}; {sum(extra.values())} extra, {sum(lost.values())} missing; "
        f"extra {str(list(extra)[:2])[:700]} missing {str(list(lost)[:2])[:700]}"
    )


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in argv or queries:
        t = time.time()
        try:
            df = queries[key](spark, sf)
            if key in oracles:
                problem = compare(df, con, oracles[key])
            else:
                problem = None
                print(f"     {key}: {df.count()} rows, no SQL")
        except Exception as e:
            problem = "".join(traceback.format_exception_only(e))[:1500]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
