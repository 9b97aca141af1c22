"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontamination, fingerprints, licenses, line_dedup, ngram_join, quality_rules, sentencepiece, spelling, substring_dedup, toxicity, url_filters, warc
from .sql import ORACLE_SQL  # noqa: F401
from .storage import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.held_out(), F.lit(False))
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted", "strongest")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256", "removed")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), exact=1)
    return kept.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(rows, conversation_repair.damage(rows))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = written(spelling.word_counts(table(spark, sf_dir, "documents")), "spelling-words")
    return spelling.spelling_groups(words)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "base_failed", "kept"]
    return quality_rules.judge_quality(table(spark, sf_dir, "documents")).select(*columns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_toxicity, op3_substring_dedup, op4_sentencepiece, op5_url_filters,
        op6_ngram_join, op7_decontamination, op8_line_dedup, op9_warc, op10_license_scan,
        op11_conversation_repair, op12_spelling_variants, op13_quality_rules,
    )
}
