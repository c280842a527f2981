"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import chat, divergence, idfiles, jaccard, language, media, mixing, packing, pii, pstable, quality, subvectors, warc
from docspark.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_path(name: str) -> str:
    """Where a file of the installed vocabulary package lies, on every machine alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_language_id")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(spark.read.parquet(f"{sf}/documents.parquet"))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")))


@query("op6_personal_data")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return pii.find(docs, pii.fit(docs))


@query("op4_mixing", mixing.ORACLE)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken(spark.read.parquet(f"{sf}/documents.parquet"))


@query("op7_retrieval_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer_path("word_bpe_49k.json"))


@query("op5_token_ids")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return idfiles.round_trip(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer_path("byte_bpe_50k.json"))


@query("op1_warc", warc.ORACLE)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf}/pages.parquet"))


@query("op9_telephony_media")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return media.digests(spark.read.parquet(f"{sf}/documents.parquet"))


@query("op8_preferences", chat.ORACLE)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return chat.neighbour_preferences(spark.read.parquet(f"{sf}/conversations.parquet"))


@query("op11_subvector_kmeans", subvectors.ORACLE)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return subvectors.cluster(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op12_source_divergence", divergence.ORACLE)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(spark.read.parquet(f"{sf}/documents.parquet"))


@query("op13_pstable_vectors")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return pstable.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
