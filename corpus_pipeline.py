"""A corpus cleaned in five stages: toxicity, line dedup, near-duplicate documents, benchmark decontamination, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landweave.llm import decontamination, line_dedup, ngram_join, sentencepiece, toxicity
from landweave.llm.storage import fresh, text_key, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. The machine is fitted on labelled documents of this stage's input.

    Null and empty texts and rows without a doc_id are judged by their text alone: null ones stay. Equal texts stay or go together.
    """
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, machine)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; n_chars is counted anew. Documents of which nothing is left go too.

    Null and empty texts stay. Repeated rows are one document and keep the same lines.
    """
    n_lines, removed = fresh(docs, "n_lines"), fresh(docs, "removed_lines")
    kept = line_dedup.line_dedup(docs, exact=1, added=(n_lines, removed))
    lost = (F.size(removed) > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    text_length = F.when(F.size(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.filter(~F.coalesce(lost, F.lit(False))).withColumn("n_chars", text_length).select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest doc_id, of rows that share it the one with the least text hash, and of equal rows one.

    Five-word shingles, similarity 0.8. A null doc_id is the last. Texts without words are no copies and all stay.
    """
    heads = ngram_join.classes(docs, words=5, share=80).filter("n_shingles > 0 AND doc_id <=> head.doc_id AND h = head.h").select("doc_id", "h").distinct()
    h, k, rank = fresh(docs, "text_hash"), fresh(docs, "head_id"), fresh(docs, "rank")
    heads = heads.select(F.col("doc_id").alias(k), F.col("h").alias(f"{h}_"))
    empty = F.coalesce(F.trim(F.regexp_replace("text", r"[\x09-\x0D ]+", " ")), F.lit("")) == ""
    whole = docs.filter(~empty).withColumn(h, text_key())
    stay = whole.join(heads, F.col("doc_id").cast("long").eqNullSafe(F.col(k)) & (F.col(h) == F.col(f"{h}_")), "left_semi")
    # Of the copies of a row one stays; groups are small, as only heads are left.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy("doc_id", h).orderBy(*(others or [h])))
    return stay.withColumn(rank, first).filter(F.col(rank) == 1).select(*docs.columns).unionByName(docs.filter(empty))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts stay; equal texts stay or go together."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with whether decoding restores its text. A null text has no ids, as an empty one; repeated rows have a row each."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Trained scores, edit distances and piece search have no SQL; stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
