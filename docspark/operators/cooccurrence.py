"""Pairs of values found in the same document, with the number of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.operators.lexicon import attribute_path, element_path, field_terms, page_terms, xpath_terms
from docspark.runtime import by_key, materialize


#: Pairs that one document may give in its own task, and values on each side of a cell of a larger one.
CELL_PAIRS, CELL_SIDE = 1 << 18, 1 << 9


def _pairs(arrays: DataFrame) -> DataFrame:
    """(a, b) of arrays (_a, _b), without nulls."""
    # the outer explodes keep Spark from adding size tests that would evaluate the arrays again; nulls are dropped after
    half = arrays.select(F.explode_outer("_a").alias("a"), "_b").where(F.col("a").isNotNull())
    return half.select("a", F.explode_outer("_b").alias("b")).where(F.col("b").isNotNull())


def _grid(arrays: DataFrame, cells: int) -> DataFrame:
    """(_a, _b) of slices, each of one array against each of the other, in about as many partitions as there are cells, up to
    what a shuffle has."""
    spark = arrays.sparkSession
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def slices(name: str) -> Column:
        starts = F.sequence(F.lit(1), F.size(name), F.lit(CELL_SIDE))
        return F.transform(starts, lambda i: F.slice(name, i, CELL_SIDE))

    sliced = arrays.select(F.monotonically_increasing_id().alias("_doc"), slices("_a").alias("_as"), slices("_b").alias("_bs"))
    rows = sliced.select("_doc", "_bs", F.posexplode("_as").alias("_i", "_a")).select("_doc", "_i", "_a", F.posexplode("_bs").alias("_j", "_b"))
    return rows.repartition(min(cells, most), "_doc", "_i", "_j").select("_a", "_b")


def cooccurrence(
    docs: DataFrame,
    a: Column,
    b: Column,
    restrict: Column | None = None,
    offset: int = 0,
    limit: int | None = None,
    frequency: str = "fragment",
    sort: bool = True,
) -> DataFrame:
    """(a, b, freq) for two array columns.

    Values are made distinct inside the row, so each document gives each pair once; the two explodes stream,
    and pairs are counted per task before the shuffle. The arrays are written once; a document of more than ``CELL_PAIRS``
    pairs is cut into a grid of array slices, which are spread over the tasks before pairs are made.
    """
    if restrict is not None:
        docs = docs.where(restrict)
    if frequency == "fragment":
        a, b = F.array_distinct(a), F.array_distinct(b)
    made = F.coalesce(F.size("_a").cast("bigint") * F.size("_b"), F.lit(0))
    both = materialize(docs.select(a.alias("_a"), b.alias("_b")).withColumn("_pairs", made), "cooccurrence")
    pairs = _pairs(both.where(F.col("_pairs") <= CELL_PAIRS))
    cells = both.where(F.col("_pairs") > CELL_PAIRS).agg(F.sum(F.ceil(F.col("_pairs") / CELL_PAIRS))).first()[0]
    if cells:
        pairs = pairs.unionByName(_pairs(_grid(both.where(F.col("_pairs") > CELL_PAIRS), cells)))
    out = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("freq"))
    return page_terms(out, ["a", "b"], offset, limit, sort=sort)


def values(docs: DataFrame, path_a: str, path_b: str, **kw) -> DataFrame:
    return cooccurrence(docs, xpath_terms(path_a), xpath_terms(path_b), **kw)


def elements(docs: DataFrame, a: str, b: str, **kw) -> DataFrame:
    return cooccurrence(docs, xpath_terms(element_path([a])), xpath_terms(element_path([b])), **kw)


def attributes(
    docs: DataFrame, element_a: str, attribute_a: str | None, element_b: str, attribute_b: str | None, **kw
) -> DataFrame:
    """Either side is an attribute of an element, or without one the element itself."""

    def side(e: str, at: str | None) -> Column:
        return xpath_terms(attribute_path([e], [at]) if at else element_path([e]))

    return cooccurrence(docs, side(element_a, attribute_a), side(element_b, attribute_b), **kw)


def fields(docs: DataFrame, a: list[str], b: list[str], **kw) -> DataFrame:
    return cooccurrence(docs, field_terms(a), field_terms(b), **kw)


def proximity(a: DataFrame, b: DataFrame, n: int, offset=0, limit=None, sort=True) -> DataFrame:
    """Pairs at most ``n`` positions apart, from rows (uri, pos, a) and (uri, pos, b).

    Positions are cut into blocks longer than ``n``; each b is offered to its own block and its neighbours and
    joined on (uri, block). A long document spreads over many keys, and a row only meets rows of
    three blocks.
    """
    width = n + 1
    block = F.floor(F.col("pos") / width)
    near = F.explode(F.array(block - 1, block, block + 1)).alias("_block")
    reach = b.select("uri", F.col("pos").alias("_pos"), "b", near)
    pairs = a.select("uri", "pos", "a", block.alias("_block")).join(by_key(reach), ["uri", "_block"])
    per_doc = pairs.where(F.abs(F.col("pos") - F.col("_pos")) <= n).select("uri", "a", "b").distinct()
    out = per_doc.groupBy("a", "b").agg(F.count(F.lit(1)).alias("freq"))
    return page_terms(out, ["a", "b"], offset, limit, sort=sort)
