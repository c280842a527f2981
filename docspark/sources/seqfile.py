"""SequenceFiles of (URI, content)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.uri import uri_build
from docspark.schema import to_docs

# The Writable classes a value may have.
VALUE_CLASSES = {
    "TEXT": "org.apache.hadoop.io.Text",
    "BYTES": "org.apache.hadoop.io.BytesWritable",
}
KEY_CLASS = "org.apache.hadoop.io.Text"


def read_sequencefile(spark: SparkSession, path: str, value_type: str = "TEXT", **uri_options) -> DataFrame:
    """URI and Text or Bytes pairs; the classes are verified by the reader. The only source that needs an RDD."""
    if value_type.upper() not in VALUE_CLASSES:
        raise ValueError(f"unsupported SequenceFile value type {value_type}")
    text = value_type.upper() == "TEXT"
    rdd = spark.sparkContext.sequenceFile(path, KEY_CLASS, VALUE_CLASSES[value_type.upper()])
    if not text:
        rdd = rdd.map(lambda kv: (kv[0], bytearray(kv[1])))
    schema = T.StructType(
        [T.StructField("key", T.StringType()), T.StructField("value", T.StringType() if text else T.BinaryType())]
    )
    df = spark.createDataFrame(rdd, schema)
    uri, reason = uri_build(F.col("key"), **uri_options)
    value = {"text" if text else "bytes": F.col("value")}
    return to_docs(df, uri=uri, skip_reason=reason, content_type=F.lit("TEXT" if text else "BINARY"), src_id=F.lit(path), **value)
