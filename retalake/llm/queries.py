"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalake.llm import (
    conversation_repair,
    decontamination,
    exact_dedup,
    filter_audit,
    html_text,
    language_model,
    license_scan,
    near_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    toxicity,
)
from retalake.llm.common import table, tokenizer_path


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark, table(spark, sf_dir, "pages"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontamination.contamination(spark, docs, table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(spark, docs, table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans")
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules.quality_filter(spark, docs, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"stats.{c}" for c in counts], "base_failed", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = quality_classifier.grades_of(table(spark, sf_dir, "labels"))
    graded = quality_classifier.graded(spark, docs, ratings, grades=3)
    tails = [F.get("tails", F.lit(k)).alias(f"p_above_{k}") for k in range(2)]
    return graded.select("doc_id", "held_out", "expected_grade", *tails)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(spark, table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.document_audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated_once(spark, table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(spark, table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_html_text": op2_html_text,
    "op3_near_dedup": op3_near_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_pii": op6_pii,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_language_model": op10_language_model,
    "op11_filter_audit": op11_filter_audit,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
