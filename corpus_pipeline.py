"""Documents from raw to packed sequences: a few operators of ``retalake.llm`` in a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm import decontamination, near_dedup, packing, pii, quality_rules
from retalake.llm.common import scratch, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows that an Arrow batch carries to a Python worker, where the session does not say. Texts are long, and a batch is
#: held by the executor and by the worker.
ARROW_ROWS = 1000


def _short_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(ARROW_ROWS))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality_rules.accepted(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    _short_batches(spark)
    return near_dedup.one_of_each(spark, docs, percent=80, size=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of personal data in its place; ``n_chars`` follows the text."""
    return pii.redacted(spark, docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids, in sequences of 2048."""
    _short_batches(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages that learn or tokenize; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of ``sf_dir``; each stage's rows are written and read again."""
    tables = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.save(stage(spark, docs, sf_dir), name)
    return docs
