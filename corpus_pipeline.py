"""From documents to packed sequences: each stage takes what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from docspark import runtime
from docspark.llm import jaccard, language, mixing, packing, pii
from docspark.llm.queries import tokenizer_path
from docspark.runtime import materialize, ship
from docspark.sinks.hadoop import delete

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows sent to a Python worker at once: documents are long, and the JVM and the worker each hold a batch or two.
ARROW_ROWS = 1000
#: Bytes sent at once, but for a row that is larger: packed postings are, and the JVM doubles the buffer that it fills.
ARROW_BYTES = 2 << 20
#: Entries of the encoder's caches: workers live through all stages beside a JVM that has grown, and must stay small.
ENCODER_CACHES = (60_000, 50_000)


#: Intermediate tables that stages wrote, of which none is needed once the stage's result is written.
_scratch: list[str] = []


def staged(stage: Stage) -> Stage:
    """``stage``, after the intermediate tables of earlier stages are deleted, but for those that ``docs`` reads."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        read = docs.inputFiles() if _scratch else []
        folders = {f.rpartition("/")[0].rpartition("/")[2] for f in read}
        for path in [p for p in _scratch if p.rpartition("/")[2] not in folders]:
            delete(spark, path)
            _scratch.remove(path)
        before = len(runtime.written)
        out = stage(spark, docs, sf_dir)
        _scratch.extend(runtime.written[before:])
        return out

    return run


def prepare(spark: SparkSession) -> None:
    """Give the tasks the package, and bound their batches, unless the session says how."""
    ship(spark)
    for limit, default, most in (("maxRecordsPerBatch", "10000", ARROW_ROWS), ("maxBytesPerBatch", "67108864b", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{limit}"
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, str(most))


@staged
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a text without letters, or far from every centroid, goes."""
    return language.keep_identified(docs)


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 75 % of its 5-word shingles, chained: the one with the smallest id."""
    return jaccard.keep_first(docs)


@staged
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    return pii.redact(docs)


@staged
def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands in it once for each pass that takes it, cut where its source's quota ends."""
    return mixing.mixed(docs)


@staged
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), caches=ENCODER_CACHES)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", target_weights),
    ("packing", packing_stage),
]

#: Trained models, connected components and tokenizers are beyond SQL. The tests run all stages and hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
