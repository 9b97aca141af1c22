"""What a run says of its layers: tiles merged, parity with reference layers, review packs.

Layers are rows (layer, geom, box, others); ``geom.kind`` is `polygon` or `point`. A layer counts as polygons (or points) if all of its rows are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import overlay as O
from .repair import validity
from .spatial import BOX, CELL
from .storage import written

# Percent of area, and share of the union, that a layer may be off before it is flagged.
AREA_TOLERANCE, LEAST_IOU = 10.0, 0.8


def measured(rows: DataFrame, *by: str, more: Sequence[Column] = ()) -> DataFrame:
    """(by, n, area_ha, more): features and, for groups of polygons only, their summed hectares (null else), with ``more`` aggregates."""
    polygon = F.bool_and(F.coalesce(F.col("geom.kind") == "polygon", F.lit(False)))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.when(polygon, F.sum(G.area(F.col("geom"))) / 10000).alias("area_ha"), *more)


def parity(own: DataFrame, reference: DataFrame, by: str = "layer", cell: float = CELL) -> DataFrame:
    """(by, n, ref_n, n_diff_pct, area_ha, ref_area_ha, area_diff_pct, iou, status) of each layer of ``own``; rows without a layer are left out.

    ``iou`` is of the unions of a layer's polygons (0 where there are none). ``status``: `no_reference`, `FLAGGED: ` and what is off, or `pass`.
    All layers are swept in one pass, so their number costs nothing but rows.
    """
    own, reference = own.filter(F.col(by).isNotNull()), reference.filter(F.col(by).isNotNull())
    theirs = measured(reference, by).select(by, F.col("n").alias("ref_n"), F.col("area_ha").alias("ref_area_ha"))
    polygons = lambda df: df.filter("geom.kind = 'polygon'")
    shared = O.iou_by(polygons(own.join(theirs.select(by), by, "left_semi")), polygons(reference), by, cell).select(by, "iou")
    rows = measured(own, by).join(theirs, by, "left").join(shared, by, "left")
    percent = lambda a, b, least: F.round(100 * (F.col(a) - F.col(b)) / F.greatest(F.col(b), F.lit(least)), 1)
    rows = rows.withColumns({"n_diff_pct": percent("n", "ref_n", 1), "area_diff_pct": percent("area_ha", "ref_area_ha", 1e-6), "iou": F.when(F.col("ref_n").isNotNull(), F.round(F.coalesce("iou", F.lit(0.0)), 4))})
    area = F.when(F.abs("area_diff_pct") > AREA_TOLERANCE, F.concat(F.lit("area diff "), F.when(F.col("area_diff_pct") > 0, "+").otherwise(""), F.col("area_diff_pct").cast("string"), F.lit("%")))
    iou = F.when(F.col("iou") < LEAST_IOU, F.concat(F.lit("IoU "), F.col("iou").cast("string"), F.lit(f" < {LEAST_IOU}")))
    flags = F.concat_ws("; ", area, iou)
    status = F.when(F.col("ref_n").isNull(), "no_reference").when(flags == "", "pass").otherwise(F.concat(F.lit("FLAGGED: "), flags))
    return rows.select(by, "n", "ref_n", "n_diff_pct", "area_ha", "ref_area_ha", "area_diff_pct", "iou", status.alias("status"))


def review_pack(own: DataFrame, reference: DataFrame, path: str, by: str = "layer", cell: float = CELL) -> DataFrame:
    """Parity of each layer with its share of all features, as it was written to ``path`` as JSON lines."""
    rows = parity(own, reference, by, cell)
    total = own.filter(F.col(by).isNotNull()).agg(F.count("*").alias("of"))  # one row
    out = rows.crossJoin(F.broadcast(total)).withColumn("pct", F.round(100 * F.col("n") / F.col("of"), 6)).drop("of")
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return own.sparkSession.read.schema(out.schema).json(path)


STAGE = ["layer", "stage"]
BROADCAST_LAYERS = 1 << 16
#: Points that one task compares, so that its memory doesn't grow with the layers.
POINTS_A_TASK = 1 << 18


def merged(rows: DataFrame, key: str = "fid") -> DataFrame:
    """What tiles wrote (tile_id, layer, stage, run_date, key, geom, box, others) as whole layers.

    Of a tile's runs the newest counts. A point on the edge of two tiles is in both: layers of points keep one of each place (least tile, then key).
    """
    # Neither runs nor layers are what rows are dealt by while their lists are small: most rows may be of one.
    small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_LAYERS else df
    runs = rows.select(*STAGE, "tile_id", "run_date").distinct()
    newest = written(runs.groupBy(*STAGE, "tile_id").agg(F.max("run_date").alias("run_date")), "newest-runs")
    rows = written(rows.join(small(newest), [*STAGE, "tile_id", "run_date"], "left_semi").select(*rows.columns), "newest-tiles")
    points = rows.groupBy(*STAGE).agg(F.bool_and(F.coalesce(F.col("geom.kind") == "point", F.lit(False))).alias("points"))
    told = rows.join(small(written(points, "point-layers")), STAGE)
    dots = told.filter("points").select(*rows.columns)
    dots = dots.repartition(max(1, -(-dots.count() // POINTS_A_TASK)), "minx", "miny")
    one = dots.groupBy(*STAGE, "minx", "miny").agg(F.min_by(F.struct(*rows.columns), F.struct("tile_id", key)).alias("row")).select("row.*")
    return told.filter("NOT points").select(*rows.columns).unionByName(one)


def merge_report(rows: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """(layer, stage, tiles, features, area_ha, valid) of ``merged`` rows; area is 0 for layers that aren't polygons only, points are valid."""
    own = rows.select(*STAGE, "tile_id", "geom", *BOX, F.xxhash64(*STAGE, "tile_id", key).alias("row_key"))
    own = written(own, "merge-rows")
    bad = validity(own.filter("geom.kind = 'polygon'"), "row_key", cell).filter("NOT is_valid").groupBy(*STAGE).agg(F.count("*").alias("n_bad"))
    out = measured(own, *STAGE, more=[F.count_distinct("tile_id").alias("tiles")]).join(bad, STAGE, "left")
    return out.select(*STAGE, "tiles", F.col("n").alias("features"), F.coalesce("area_ha", F.lit(0.0)).alias("area_ha"), F.col("n_bad").isNull().alias("valid"))
