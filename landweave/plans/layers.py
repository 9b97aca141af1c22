"""Opportunity layers, enrichment and the constraints that every layer subtracts, over the stand-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..functions import geometry as G
from ..operators import touch
from ..operators import overlay as O
from ..operators import scoring as S
from ..operators import spatial as X
from ..operators.buffer import buffered
from ..operators.checks import EmptyLayerError
from ..operators.enrich import Join, enriched, resolve  # noqa: F401
from ..operators.storage import written

# Metres around a waterline, by its type.
BUFFERS = {"District": 50, "Local": 30, "National": 150, "Regional": 100}


def boxes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = fixtures.layer(spark, sf_dir, name)
    return df.withColumns({c: F.col(c).cast("double") for c in X.BOX}).withColumn("geom", G.box_polygon())


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.as_points(fixtures.layer(spark, sf_dir, "fx_point"))


def zones(df: DataFrame, wanted: list[str], column: str = "number") -> DataFrame:
    """Rows whose trimmed, lower-cased zone is wanted; all rows where the table has no such column (whatever its case)."""
    found = next((c for c in df.columns if c.lower() == column), None)
    return df if found is None else df.filter(F.lower(F.trim(found)).isin([w.strip().lower() for w in wanted]))


def buffered_box(lines: DataFrame, distance) -> DataFrame:
    """Axis-parallel lines widened by a distance, square at the ends, as polygons."""
    d = F.lit(distance) if not hasattr(distance, "alias") else distance
    out = lines.select(
        "fid", (F.least("x1", "x2") - d).cast("double").alias("minx"), (F.least("y1", "y2") - d).cast("double").alias("miny"),
        (F.greatest("x1", "x2") + d).cast("double").alias("maxx"), (F.greatest("y1", "y2") + d).cast("double").alias("maxy"),
    )
    return out.withColumn("geom", G.box_polygon())


def constraints(spark: SparkSession, sf_dir: str, land_cover: bool = True) -> DataFrame:
    """(source, geom, box) of everything that rules land out; peat leaves land cover out."""
    parts = {
        "landcover": boxes(spark, sf_dir, "fx_landcover").filter(F.col("mode").isin("20", "21", "11", "1")) if land_cover else None,
        "spz": zones(boxes(spark, sf_dir, "fx_spz"), ["1", "1c", "2", "2c"]),
        "roads": buffered_box(fixtures.layer(spark, sf_dir, "fx_line").filter("fid % 2 = 1"), 10),
        "rail": buffered_box(fixtures.layer(spark, sf_dir, "fx_line").filter("fid % 10 = 0"), 20),
        "water": boxes(spark, sf_dir, "fx_raf").filter("fid % 15 = 0"),
    }
    rows = [df.select(F.lit(name).alias("source"), "fid", "geom", *X.BOX) for name, df in parts.items() if df is not None]
    return reduce(DataFrame.unionByName, rows)


def leaky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate points in High or Medium flood extent, outside constraints, runoff attenuation and flood zone 3, inside the boundary."""
    flood, candidates = boxes(spark, sf_dir, "fx_flood"), points(spark, sf_dir)
    out = constraints(spark, sf_dir).select("geom", *X.BOX).unionByName(boxes(spark, sf_dir, "fx_raf").select("geom", *X.BOX)).unionByName(flood.filter("risk_band = 'Low'").select("geom", *X.BOX))
    where = X.located(candidates, {"flooded": flood.filter("risk_band IN ('High', 'Medium')"), "ruled_out": out}, {"bounded": boxes(spark, sf_dir, "fx_boundary")}, {})
    # Points are read again by each stage that follows, so they are written once.
    return written(candidates.join(where.filter("flooded AND NOT ruled_out AND bounded").select("fid"), "fid", "left_semi"), "leaky-points")


#: The seven joins in their order.
JOINS = [
    Join("water bodies", rename={"WB_ID": "WB_ID", "WB_NAME": "WB_NAME"}),
    Join("land cover", rename={"mode": "CEH_LU"}),
    Join("agricultural land", rename={"alc_grade": "alc_grade"}),
    Join("soil", rename={"SOIL_GROUP": "sl_grp", "SOIL_TEX": "sl_tex", "SOIL_DEPTH": "sl_dep"}),
    Join("recharge", column_match={"prioriti": "rch_pt"}, on_fail="raise", repaired=True, report=True),
    Join("habitats", column_match={"class": "prio_hb"}),
    Join("woodland sensitivity", column_match={"sensit": "wood_s"}, repaired=True),
]


def joined_layer(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The stand-in for a dataset that is joined; KeyError for others. Soil has no depth, recharge covers two thirds of the square."""
    grid = boxes(spark, sf_dir, "fx_grid1k")
    found = {
        "water bodies": lambda: boxes(spark, sf_dir, "fx_waterbody"),
        "land cover": lambda: boxes(spark, sf_dir, "fx_landcover"),
        "agricultural land": lambda: grid.select("fid", "alc_grade", "geom", *X.BOX),
        "soil": lambda: grid.select("fid", "soil_group", F.concat(F.lit("TEX"), F.col("fid") % 3).alias("Soil_Tex"), "geom", *X.BOX),
        "recharge": lambda: grid.filter("fid % 3 <> 0").select("fid", F.col("prioritisation").alias("PRIORITISATION"), "geom", *X.BOX),
        "habitats": lambda: grid.select("fid", "class", "geom", *X.BOX),
        "woodland sensitivity": lambda: boxes(spark, sf_dir, "fx_spz").withColumnRenamed("number", "sensitivit"),
    }
    return found[dataset]()


def enrich(spark: SparkSession, sf_dir: str, layer: DataFrame, joins: list[Join] = JOINS, **options) -> DataFrame:
    """Attributes of the first polygon (least fid) of each of the joined layers that holds the point; nothing there: nulls."""
    return enriched(layer, joins, lambda dataset: joined_layer(spark, sf_dir, dataset), **options)


def leaky_prioritised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.priority_scores(enrich(spark, sf_dir, leaky(spark, sf_dir)))


AREA = (401000.0, 301000.0, 405000.0, 305000.0)


def area_of_interest(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(*(F.lit(v).alias(c) for c, v in zip(X.BOX, AREA, strict=True))).withColumn("geom", G.box_polygon())


def aoi_union(tiles: DataFrame, boundary: DataFrame, cell: float = X.CELL) -> DataFrame:
    """(area_id, geom, box, area): one polygon of the whole tiles that overlap the boundary with some area; ValueError where none does."""
    there = written(O.overlay(tiles, boundary, "intersection", cell=cell).filter("area > 0").select("fid"), "aoi-tiles")
    if there.isEmpty():
        raise ValueError("no tile overlaps the boundary")
    return O.union(tiles.join(there, "fid", "left_semi").withColumn("area_id", F.lit(0).cast("long")), "area_id", cell=cell)


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.with_bounds(fixtures.layer(spark, sf_dir, "fx_shape").withColumn("geom", G.shape_polygon()))


def sources(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """(fid, geom, box) of the polygons a layer starts from; fids of two sources are told apart by their parity."""
    flood, raf, shape = boxes(spark, sf_dir, "fx_flood"), boxes(spark, sf_dir, "fx_raf"), shapes(spark, sf_dir)
    parts = {
        "pond": [raf],
        "bunds": [flood.filter("risk_band IN ('High', 'Medium')")],
        "floodplain": [flood.filter("risk_band = 'Very Low'"), shape.filter("shape_kind = 1")],
        "riparian": [shape.filter("shape_kind = 2")],
        "woodland": [shape.filter("shape_kind = 0"), shape.filter("shape_kind = 3")],
        "peat": [shape.filter("s <= 60")],
    }[layer]
    return reduce(DataFrame.unionByName, (p.select((F.col("fid") * len(parts) + i).alias("fid"), "geom", *X.BOX) for i, p in enumerate(parts)))


def masks(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """What a layer subtracts: constraints (peat: without land cover), woodland's own and, for bunds, runoff attenuation and the waterlines' buffers."""
    out = constraints(spark, sf_dir, land_cover=layer != "peat").select("geom", *X.BOX)
    if layer == "woodland":
        out = out.unionByName(zones(boxes(spark, sf_dir, "fx_spz"), ["3"]).select("geom", *X.BOX))
    if layer == "bunds":
        lines = fixtures.layer(spark, sf_dir, "fx_line").withColumn("r", S.lookup(F.col("type"), BUFFERS)).filter("r IS NOT NULL")
        out = out.unionByName(boxes(spark, sf_dir, "fx_raf").select("geom", *X.BOX)).unionByName(buffered_box(lines, F.col("r")).select("geom", *X.BOX))
    return out


#: Square metres below which a polygon of a layer is left out.
LEAST_AREA = {"bunds": 20.0}
#: Metres by which sources are widened first; such layers keep what is left of a cluster together.
WIDENED = {"peat": 10.0}


def opportunity(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """(layer, geom, box, area): a layer's single polygons. Sources that meet are one cluster, whose polygons are merged while masks are subtracted
    and the area of interest cuts it, so each cell is swept once."""
    start = sources(spark, sf_dir, layer)
    if start.isEmpty():
        raise EmptyLayerError(f"{layer}: no sources")
    if layer in WIDENED:
        start = written(buffered(start, WIDENED[layer]), "layer-widened")
    led = start.join(touch.clusters(start).withColumnRenamed("node", "fid"), "fid")
    left = O.remainder(written(led, "layer-sources"), masks(spark, sf_dir, layer), area_of_interest(spark), by="root")
    whole = left if layer in WIDENED else O.single(left, "root").filter(F.col("area") >= LEAST_AREA.get(layer, 0.0))
    return whole.select(F.lit(layer).alias("layer"), "geom", *X.BOX, "area")
