"""Layers and landed pages of features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures

#: Names that can be loaded and where they lie.
REGISTRY = {"flood": "fx_flood", "landcover": "fx_landcover", "spz": "fx_spz", "waterbody": "fx_waterbody", "raf": "fx_raf"}


def load_layer(spark: SparkSession, sf_dir: str, name: str, box: tuple | None = None, where: str | None = None) -> DataFrame:
    """A registered layer, restricted to what touches a box and to a condition; both reach the scan. Unknown names raise KeyError."""
    df = fixtures.layer(spark, sf_dir, REGISTRY[name])
    if box:
        a, c, b, d = box
        df = df.filter((F.col("maxx") >= a) & (F.col("minx") <= b) & (F.col("maxy") >= c) & (F.col("miny") <= d))
    return df.filter(where) if where else df


def union_layers(parts: dict[str, DataFrame], column: str) -> DataFrame:
    """All rows of some layers, with the layer's name."""
    return reduce(DataFrame.unionByName, (df.withColumn(column, F.lit(name)) for name, df in parts.items()))


def tagged(parts: dict[tuple, DataFrame], columns: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.withColumns({c: F.lit(v) for c, v in zip(columns, tags, strict=True)}) for tags, df in parts.items()))


def project(df: DataFrame, wanted: dict[str, str], keep: list[str]) -> DataFrame:
    """Columns by name in any case under other names; missing ones are null strings."""
    known = {c.lower(): c for c in df.columns}
    return df.select(*keep, *((F.col(known[a.lower()]) if a.lower() in known else F.lit(None).cast("string")).alias(b) for a, b in wanted.items()))


def dedup(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def incomplete(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Datasets whose rows aren't as many as the server told; those of which it told nothing are left out."""
    return rows.groupBy("dataset").agg(F.count("*").alias("got")).join(told.filter("expected IS NOT NULL"), "dataset").filter("got <> expected")


def require_complete(rows: DataFrame, told: DataFrame) -> None:
    """Raises where a load is partial."""
    if bad := incomplete(rows, told).collect():
        raise ValueError("incomplete: " + "; ".join(f"{r.dataset} expected {r.expected}, got {r.got}" for r in bad))
