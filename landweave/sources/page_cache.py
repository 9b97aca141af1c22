"""Which pages of a paged service are still to be got: a ledger of stored pages under the identity of the query that got them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identity(decimals: int = 0) -> Column:
    """A hash of layer, box (array, rounded), condition, page size and the number of objects told; null where one of them is null, too."""
    box = F.transform("box", lambda v: F.round(v, decimals) + 0.0)
    parts = F.struct("layer", box.alias("box"), "condition", "page_size", "told")
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)


def identified(queries: DataFrame, decimals: int = 0) -> DataFrame:
    """Queries (layer, box, condition, page_size, told), one a layer, with their ``identity``."""
    return queries.withColumn("identity", identity(decimals))


def stale(queries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the ledger (layer, identity, offset) that were got under another query of their layer: they don't count. Layers not asked for stay."""
    return ledger.join(identified(queries).select("layer", F.col("identity").alias("_now")), "layer").filter("NOT identity <=> _now").drop("_now")


def missing(queries: DataFrame, ledger: DataFrame) -> DataFrame:
    """(layer, identity, offset) of pages to get: those of all objects told that the ledger hasn't under this identity.

    Where the number wasn't told, only the first gap is known: after it one must ask again. No object told: nothing to get.
    """
    asked = identified(queries).select("layer", "identity", "page_size", F.col("told").cast("long").alias("told"))
    stored = ledger.select("identity", "offset").distinct()
    far = stored.groupBy("identity").agg(F.max("offset").alias("far"))
    ends = asked.join(far, "identity", "left").withColumn("end", F.when(F.col("told").isNotNull(), F.col("told") - 1).otherwise(F.coalesce(F.col("far") + F.col("page_size"), F.lit(0).cast("long")))).filter("end >= 0")
    offsets = ends.withColumn("offset", F.explode(F.sequence(F.lit(0).cast("long"), "end", F.col("page_size").cast("long"))))
    gaps = offsets.join(stored, ["identity", "offset"], "left_anti")
    known = gaps.filter("told IS NOT NULL").select("layer", "identity", "offset")
    return known.unionByName(gaps.filter("told IS NULL").groupBy("layer", "identity").agg(F.min("offset").alias("offset")))


def resume(queries: DataFrame, ledger: DataFrame) -> DataFrame:
    """(layer, resume_from): the first page to get of each layer; null: all are there."""
    first = missing(queries, ledger).groupBy("layer").agg(F.min("offset").alias("resume_from"))
    return queries.select("layer").join(first, "layer", "left")
