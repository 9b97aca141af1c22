"""Run ledger: latest status of each tile and layer, what is left to do, counts and checks of merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ["ok", "empty", "missing", "error", "skip"]


def with_kind(rows: DataFrame) -> DataFrame:
    """``kind``: the status up to a colon."""
    return rows.withColumn("kind", F.split("status", ":")[0])


def latest(rows: DataFrame) -> DataFrame:
    """The newest row of each tile and layer; later events win ties. One aggregate: nothing is sorted."""
    return rows.groupBy("tile_id", "layer").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("ts"))


def layer_status(rows: DataFrame) -> DataFrame:
    """Tiles of each kind by layer."""
    return with_kind(rows).groupBy("layer").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in KINDS))


def todo(tiles: DataFrame, rows: DataFrame) -> DataFrame:
    """Tiles that aren't done: those without rows, and those with an error in any layer."""
    done = with_kind(rows).groupBy("tile_id").agg(F.bool_or(F.col("kind") == "error").alias("failed")).filter("NOT failed")
    return tiles.join(done, "tile_id", "left_anti")


def crosscheck(rows: DataFrame) -> DataFrame:
    """By layer, tiles that contributed (even nothing) against tiles with features."""
    kind = with_kind(rows)
    out = kind.groupBy("layer").agg(
        F.countDistinct(F.when(F.col("kind").isin("ok", "empty"), F.col("tile_id"))).alias("contributing"), F.countDistinct(F.when(F.col("kind") == "ok", F.col("tile_id"))).alias("ok")
    )
    return out.withColumn("warn", F.col("contributing") != F.col("ok"))


def crosscheck_stages(contributions: DataFrame, rows: DataFrame) -> DataFrame:
    """(layer, stage, contributing, ok, warn): tiles that contributed to a stage (tile_id, layer, stage) against those that the ledger says are ok.

    Later stages must agree. Of an opportunity stage a tile may have something in its halo only, so it warns of fewer. An empty ledger warns of nothing.
    """
    ok = with_kind(rows).filter("kind = 'ok'").groupBy("layer").agg(F.count_distinct("tile_id").alias("ok"))
    both = contributions.groupBy("layer", "stage").agg(F.count_distinct("tile_id").alias("contributing")).join(ok, "layer", "left").withColumn("ok", F.coalesce("ok", F.lit(0).cast("long")))
    off = F.when(F.col("stage").isin("supplemented", "prioritised"), F.col("contributing") != F.col("ok")).otherwise((F.col("stage") == "opportunity") & (F.col("contributing") < F.col("ok")))
    return both.select("layer", "stage", "contributing", "ok", (F.lit(not rows.isEmpty()) & F.coalesce(off, F.lit(False))).alias("warn"))


def error_tiles(rows: DataFrame) -> DataFrame:
    """(tile_id, n): tiles with an error in some layer, and in how many."""
    return with_kind(rows).filter("kind = 'error'").groupBy("tile_id").agg(F.count_distinct("layer").alias("n"))


def progress(tiles: DataFrame, now: Column | datetime, late_after: float) -> DataFrame:
    """One row of tiles (tile_id, started, ended; null: not yet) at ``now``: total, done, running, minutes since the first start, tiles a minute, minutes left (null: unknown), late (running for over ``late_after`` minutes)."""
    now = now if isinstance(now, Column) else F.lit(now)
    minutes = lambda a, b: (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 6e7
    going = F.col("started").isNotNull() & F.col("ended").isNull()
    sums = tiles.agg(
        F.count("*").alias("total"), F.count("ended").alias("done"), F.count_if(going).alias("running"), minutes(F.min("started"), now).alias("minutes"),
        F.count_if(going & (minutes(F.col("started"), now) > late_after)).alias("late"),
    )
    sums = sums.withColumn("rate", F.when(F.col("minutes") > 0, F.col("done") / F.col("minutes")).otherwise(0.0))
    return sums.withColumn("minutes_left", F.try_divide(F.col("total") - F.col("done"), F.col("rate")))


def tile_ids(rows: DataFrame, name: str, order: str) -> DataFrame:
    """``tile_id``: the name with runs of other characters as underscores (``wb`` and the order where nothing is left); repeats are numbered."""
    plain = F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    out = rows.withColumn("_s", F.when(plain == "", F.concat(F.lit("wb"), F.lpad(F.col(order).cast("string"), 4, "0"))).otherwise(plain))
    n = F.row_number().over(Window.partitionBy("_s").orderBy(order)) - 1
    return out.withColumn("tile_id", F.when(n == 0, F.col("_s")).otherwise(F.concat_ws("_", "_s", n.cast("string")))).drop("_s")


def coverage(rows: DataFrame, by: str, scored: list[str], grade: str = "alc_grade") -> DataFrame:
    """By group: area, and the percentages of it with a grade and with a scored grade; 0 where there is no area."""
    has = F.col(grade).isNotNull()
    sums = rows.groupBy(by).agg(F.sum("area").alias("area"), F.sum(F.when(has, F.col("area")).otherwise(0.0)).alias("graded_area"), F.sum(F.when(F.col(grade).isin(scored), F.col("area")).otherwise(0.0)).alias("scored_area"))
    share = lambda c: F.coalesce(100 * F.try_divide(c, "area"), F.lit(0.0))
    return sums.withColumns({"graded": share("graded_area"), "scored": share("scored_area")})
