"""User transforms and user reducers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.runtime import ship

BATCH = 100


def transform_docs(
    docs: DataFrame,
    fn: Callable[[dict, dict], dict | list[dict]],
    param: str | None = None,
    batch: int = BATCH,
) -> DataFrame:
    """Run ``fn(content, context)`` on each document, in the tasks that hold them.

    ``content`` is ``{"uri", "value"}``, ``context`` is ``{"transform_param"}``; the result is a changed
    content, or a list of contents. Other columns are copied to every result. A document whose transform
    fails is kept with the error as ``skip_reason``.
    """
    ship(docs.sparkSession)
    names = docs.columns

    def one(row) -> Iterator[dict]:
        base = row._asdict()
        try:
            made = fn({"uri": base["uri"], "value": base["text"]}, {"transform_param": param})
            for content in made if isinstance(made, list) else [made]:
                yield {**base, "uri": content["uri"], "text": content["value"]}
        except Exception as e:  # user code: report the document, go on with the others
            yield {**base, "skip_reason": f"{type(e).__name__}: {e}"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                rows = [r for row in part.itertuples(index=False, name="Doc") for r in one(row)]
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return docs.mapInPandas(run, docs.schema)


def transform_column(docs: DataFrame, text: Column, uri: Column | None = None) -> DataFrame:
    """A transform written as expressions; stays inside the JVM."""
    out = docs.withColumn("text", text)
    return out if uri is None else out.withColumn("uri", uri)


def transform_one_to_many(docs: DataFrame, contents: Column) -> DataFrame:
    """Several documents per document: ``contents`` is an array of struct (uri, text)."""
    rest = [c for c in docs.columns if c not in ("uri", "text")]
    return docs.select(F.inline(contents), *rest).select(*docs.columns)


_TAG = re.compile(r"(<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>)|(</?)([^\s/>!?]+)", re.S)


def transform_rename_elements(docs: DataFrame, upper: bool = False, text: str = "text") -> DataFrame:
    """Lower- or upper-case all element names; attributes, text, comments and CDATA stay as they are."""

    ship(docs.sparkSession)

    def case(name: str) -> str:
        prefix, colon, local = name.rpartition(":")
        return prefix + colon + (local.upper() if upper else local.lower())

    @F.pandas_udf("string")
    def rename(xml: pd.Series) -> pd.Series:
        return xml.map(
            lambda x: None if x is None else _TAG.sub(lambda m: m[1] if m[1] is not None else m[2] + case(m[3]), x)
        )

    return docs.withColumn(text, rename(text))


def custom_reduce(rows: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """A user reducer as aggregate expressions: combined in the tasks before the shuffle."""
    return rows.groupBy(*keys).agg(*aggregates)


def custom_reduce_partials(
    rows: DataFrame,
    keys: list[str],
    fold: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    salts: int = 64,
) -> DataFrame:
    """A user reducer in Python whose result can be reduced again (sums, maxima, sketches).

    ``fold`` takes rows of one key and returns fewer rows of the same columns. It runs on batches inside the
    tasks, then on salted keys, then once per key on what is left, so that a hot key never meets as a whole.
    """

    ship(rows.sparkSession)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [fold(g) for _, g in pdf.groupby(keys, dropna=False, sort=False)]
            if parts:
                yield pd.concat(parts)

    partial = rows.mapInPandas(combine, schema)
    # a salt of the row itself stays the same when a task is repeated
    partial = partial.withColumn("_salt", F.pmod(F.xxhash64(*partial.columns), F.lit(salts)).cast("int"))
    salted = partial.groupBy(*keys, "_salt").applyInPandas(lambda pdf: fold(pdf.drop(columns="_salt")), schema)
    return salted.groupBy(*keys).applyInPandas(fold, schema)
