"""The shared folder that cuts lineage, and small helpers for written tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import shared_dir, written  # noqa: F401


@contextmanager
def rows_a_batch(spark: SparkSession, n: int) -> Iterator[None]:
    """Arrow batches of at most ``n`` rows in what is run inside, for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores, so that it is no column of ``df``, whatever its capitals."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key():
    """Tells rows of one doc_id with different texts apart; equal rows share it."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
