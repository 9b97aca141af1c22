"""Registered queries of the spatial operators, and the SQL that each is compared with."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import geometry as G
from ..functions import reproject as R
from ..operators import ledger, storage
from ..operators import overlay as O
from ..operators import scoring as S
from ..operators import spatial as X
from ..operators.enrich import Join, report
from ..sources import landing, page_cache, pages
from . import layers as L
from . import lines, polygons, reports  # noqa: F401  register their queries
from .registry import ORACLE_SQL, QUERIES, query  # noqa: F401

fx = fixtures.layer

QUAD = (
    "max(CASE WHEN m.minx<=p.x AND p.x<m.maxx AND m.miny<=p.y AND p.y<m.maxy THEN 1 ELSE 0 END)*max(CASE WHEN m.minx<p.x AND p.x<=m.maxx AND m.miny<=p.y AND p.y<m.maxy THEN 1 ELSE 0 END)"
    "*max(CASE WHEN m.minx<=p.x AND p.x<m.maxx AND m.miny<p.y AND p.y<=m.maxy THEN 1 ELSE 0 END)*max(CASE WHEN m.minx<p.x AND p.x<=m.maxx AND m.miny<p.y AND p.y<=m.maxy THEN 1 ELSE 0 END)"
)


def inside(points: str, mask: str) -> str:
    return f"SELECT p.fid FROM {points} p JOIN {mask} m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy GROUP BY p.fid HAVING {QUAD} = 1"


SPZ = "lower(trim(number)) IN ('1','1c','2','2c')"
FLOOD = "fl AS (SELECT * FROM fx_flood WHERE risk_band IN ('High','Medium'))"
CONS = (
    "cons AS (SELECT 'landcover' AS source, minx, miny, maxx, maxy FROM fx_landcover WHERE mode IN ('20','21','11','1') UNION ALL SELECT 'spz', minx, miny, maxx, maxy FROM fx_spz WHERE " + SPZ
    + " UNION ALL SELECT 'roads', x1-10, y1-10, x2+10, y2+10 FROM fx_line WHERE fid % 2 = 1 UNION ALL SELECT 'rail', x1-20, y1-20, x2+20, y2+20 FROM fx_line WHERE fid % 10 = 0"
    " UNION ALL SELECT 'water', minx, miny, maxx, maxy FROM fx_raf WHERE fid % 15 = 0)"
)
CONS_FX = ("fx_landcover", "fx_spz", "fx_line", "fx_raf")

# Scans and filters


@query("SELECT fid, risk_band FROM fx_flood WHERE maxx>=402000 AND minx<=404000 AND maxy>=302000 AND miny<=304000", "fx_flood")
def scan_bbox(spark, d):
    return fx(spark, d, "fx_flood").filter("maxx>=402000 AND minx<=404000 AND maxy>=302000 AND miny<=304000").select("fid", "risk_band")


@query("SELECT fid FROM fx_flood WHERE maxx>=402000 AND minx<=404000 AND maxy>=302000 AND miny<=304000 AND risk_band='High'", "fx_flood")
def scan_layer(spark, d):
    return pages.load_layer(spark, d, "flood", box=(402000, 302000, 404000, 304000), where="risk_band='High'").select("fid")


@query("SELECT fid, 'odd' AS layer FROM fx_line WHERE fid % 2 = 1 UNION ALL SELECT fid, 'third' FROM fx_line WHERE fid % 3 = 0 UNION ALL SELECT fid, 'fifth' FROM fx_line WHERE fid % 5 = 0", "fx_line")
def scan_roads_union(spark, d):
    return pages.union_layers({k: fx(spark, d, "fx_line").filter(w).select("fid") for k, w in (("odd", "fid % 2 = 1"), ("third", "fid % 3 = 0"), ("fifth", "fid % 5 = 0"))}, "layer")


@query("SELECT fid, CAST(fid % 4 AS VARCHAR) AS zone FROM fx_spz", "fx_spz")
def scan_zone_tiled(spark, d):
    return pages.union_layers({str(z): fx(spark, d, "fx_spz").filter(f"fid % 4 = {z}").select("fid") for z in range(4)}, "zone")


@query("SELECT subsidiary, service_type, count(*) AS n FROM fx_boundary GROUP BY 1, 2", "fx_boundary")
def scan_components(spark, d):
    parts = {(s, t): fx(spark, d, "fx_boundary").filter(f"subsidiary='{s}' AND service_type='{t}'").select("fid") for s in ("ST", "HD") for t in ("clean_water", "waste")}
    return pages.tagged(parts, ["subsidiary", "service_type"]).groupBy("subsidiary", "service_type").agg(F.count("*").alias("n"))


@query("SELECT fid FROM fx_landcover WHERE mode IN ('20','21','11','1')", "fx_landcover")
def filter_landcover(spark, d):
    return fx(spark, d, "fx_landcover").filter(F.col("mode").isin("20", "21", "11", "1")).select("fid")


@query("SELECT fid, lower(trim(number)) AS zone FROM fx_spz WHERE " + SPZ, "fx_spz")
def filter_spz(spark, d):
    return L.zones(fx(spark, d, "fx_spz"), ["1", "1c", "2", "2C "]).select("fid", F.lower(F.trim("number")).alias("zone"))


@query("SELECT fid FROM fx_flood WHERE risk_band IN ('High','Medium')", "fx_flood")
def filter_flood_band(spark, d):
    return fx(spark, d, "fx_flood").filter("risk_band IN ('High','Medium')").select("fid")


@query("SELECT fid FROM fx_spz WHERE number IN ('1','3')", "fx_spz")
def filter_sensitivity(spark, d):
    df = fx(spark, d, "fx_spz").withColumnRenamed("number", "sensitivit")
    return df.filter(F.col(L.resolve(df.columns, "sensitivity", "sensit")).isin("1", "3")).select("fid")


@query("SELECT fid, alc_grade AS grade, CAST(NULL AS VARCHAR) AS absent FROM fx_grid1k", "fx_grid1k")
def project_join_side(spark, d):
    return pages.project(fx(spark, d, "fx_grid1k"), {"ALC_GRADE": "grade", "no_such": "absent"}, keep=["fid"])


@query("SELECT fid FROM fx_shape", "fx_shape")
def filter_geom_family(spark, d):
    shapes = fx(spark, d, "fx_shape").select("fid", G.shape_polygon().alias("geom"))
    lines = fx(spark, d, "fx_line").select("fid", G.line(("x1", "y1"), ("x2", "y2")).alias("geom"))
    return shapes.unionByName(lines).filter("geom.kind = 'polygon'").select("fid")


@query("SELECT fid FROM fx_flood WHERE (maxx-minx)*(maxy-miny) >= 5000", "fx_flood")
def filter_min_area(spark, d):
    return L.boxes(spark, d, "fx_flood").filter(G.area(F.col("geom")) >= 5000).select("fid")


# Measures

SHAPE_AREA = "CASE shape_kind WHEN 0 THEN s*s/2.0 WHEN 1 THEN 0.75*s*s WHEN 2 THEN 0.75*s*s ELSE s*s/2.0 END"


def shapes(spark, d):
    return G.with_bounds(fx(spark, d, "fx_shape").withColumn("geom", G.shape_polygon()))


@query(f"SELECT fid, CAST({SHAPE_AREA} AS DOUBLE) AS area FROM fx_shape", "fx_shape")
def geom_area(spark, d):
    return shapes(spark, d).select("fid", G.area(F.col("geom")).alias("area"))


@query("SELECT fid, CAST(ox AS DOUBLE) AS minx, CAST(oy AS DOUBLE) AS miny, CAST(ox+s AS DOUBLE) AS maxx, CAST(oy+s AS DOUBLE) AS maxy FROM fx_shape", "fx_shape")
def geom_bounds(spark, d):
    return shapes(spark, d).select("fid", *X.BOX)


@query("SELECT fid, CAST(x2-x1+y2-y1 AS DOUBLE) AS len FROM fx_line", "fx_line")
def geom_length(spark, d):
    return fx(spark, d, "fx_line").select("fid", G.length(G.line(("x1", "y1"), ("x2", "y2"))).alias("len"))


@query("SELECT fid, CAST(CASE shape_kind WHEN 0 THEN 4 WHEN 1 THEN 7 WHEN 2 THEN 10 ELSE 5 END AS BIGINT) AS n FROM fx_shape", "fx_shape")
def geom_num_coords(spark, d):
    return shapes(spark, d).select("fid", G.num_coords(F.col("geom")).cast("long").alias("n"))


@query("SELECT region AS fid, CAST(4000000 AS DOUBLE) AS area FROM fx_waterbody", "fx_waterbody")
def geom_parts(spark, d):
    multi = L.boxes(spark, d, "fx_waterbody").groupBy(F.col("region").alias("fid")).agg(F.struct(F.lit("polygon").alias("kind"), F.flatten(F.collect_list("geom.parts")).alias("parts")).alias("geom"))
    return G.explode_parts(multi).select("fid", G.area(F.col("geom")).alias("area"))


@query("SELECT c_custkey AS fid, trim(regexp_replace(lower(concat(' ', c_mktsegment, ' (', CAST(c_custkey AS VARCHAR), ')')), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM customer")
def slug(spark, d):
    name = F.concat(F.lit(" "), "c_mktsegment", F.lit(" ("), F.col("c_custkey").cast("string"), F.lit(")"))
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("fid"), G.slug(name).alias("slug"))


# Spatial joins


@query(f", {FLOOD} " + inside("fx_point", "fl"), "fx_point", "fx_flood")
def keep_within_points(spark, d):
    return X.keep_within(L.points(spark, d), L.boxes(spark, d, "fx_flood").filter("risk_band IN ('High','Medium')")).select("fid")


@query(f", mk AS (SELECT minx, miny, maxx, maxy FROM fx_landcover WHERE mode IN ('20','21','11','1') UNION ALL SELECT minx, miny, maxx, maxy FROM fx_spz WHERE {SPZ}) SELECT fid FROM fx_point WHERE fid NOT IN ({inside('fx_point', 'mk')})", "fx_point", "fx_landcover", "fx_spz")
def subtract_points(spark, d):
    mask = L.constraints(spark, d).filter("source IN ('landcover', 'spz')")
    return X.subtract(L.points(spark, d), mask).select("fid")


@query("SELECT DISTINCT p.fid FROM fx_point p JOIN fx_boundary m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy", "fx_point", "fx_boundary")
def clip_aoi(spark, d):
    return X.clip_points(L.points(spark, d), L.boxes(spark, d, "fx_boundary")).select("fid")


@query("SELECT DISTINCT p.fid FROM fx_flood p JOIN fx_boundary m ON p.maxx>=m.minx AND p.minx<=m.maxx AND p.maxy>=m.miny AND p.miny<=m.maxy", "fx_flood", "fx_boundary")
def post_fetch_clip(spark, d):
    boxes = L.boxes(spark, d, "fx_flood")
    return boxes.join(X.candidates(boxes.select("fid", *X.BOX), L.boxes(spark, d, "fx_boundary").select(*X.BOX)).select("fid").distinct(), "fid", "left_semi").select("fid")


@query("SELECT p.fid, m.fid AS zone FROM fx_point p JOIN fx_spz m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy", "fx_point", "fx_spz")
def spatial_join(spark, d):
    return X.holding(L.points(spark, d).select("fid", *X.BOX), L.boxes(spark, d, "fx_spz"), "fid", key="fid").select("fid", F.col("r_fid").alias("zone"))


@query("SELECT p.fid, min_by(m.wb_id, m.fid) AS wb_id FROM fx_point p LEFT JOIN fx_waterbody m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy GROUP BY 1", "fx_point", "fx_waterbody")
def sjoin_rep_point(spark, d):
    return X.join_first(L.points(spark, d), L.boxes(spark, d, "fx_waterbody"), ["wb_id"]).select("fid", "wb_id")


@query("SELECT p.fid, min_by(m.wb_id, m.fid) AS wb_id FROM fx_point p LEFT JOIN fx_waterbody m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy GROUP BY 1", "fx_point", "fx_waterbody")
def first_match(spark, d):
    pairs = X.touching(L.points(spark, d).select("fid", *X.BOX), L.boxes(spark, d, "fx_waterbody").select("fid", "wb_id", "geom", *X.BOX))
    kept = X.newest(pairs, ["fid"], [F.col("r_fid")]).select("fid", F.col("r_wb_id").alias("wb_id"))
    return L.points(spark, d).select("fid").join(kept, "fid", "left")


NEAR = "(p.x-greatest(l.x1,least(p.x,l.x2)))*(p.x-greatest(l.x1,least(p.x,l.x2)))+(p.y-greatest(l.y1,least(p.y,l.y2)))*(p.y-greatest(l.y1,least(p.y,l.y2)))"


@query(f"SELECT DISTINCT p.fid FROM fx_point p JOIN fx_line l ON {NEAR} <= 100 AND l.fid % 2 = 1", "fx_point", "fx_line")
def buffer_const(spark, d):
    return X.near_segments(L.points(spark, d), fx(spark, d, "fx_line").filter("fid % 2 = 1").withColumn("r", F.lit(10)), "r")


@query(f", b AS (SELECT *, CASE type WHEN 'District' THEN 50 WHEN 'Local' THEN 30 WHEN 'National' THEN 150 WHEN 'Regional' THEN 100 END AS r FROM fx_line) SELECT DISTINCT p.fid FROM fx_point p JOIN b l ON {NEAR} <= r*r", "fx_point", "fx_line")
def buffer_keyed(spark, d):
    lines = fx(spark, d, "fx_line").withColumn("r", S.lookup(F.col("type"), L.BUFFERS)).filter("r IS NOT NULL")
    return X.near_segments(L.points(spark, d), lines, "r")


AREA = "greatest(0, least(a.maxx,b.maxx)-greatest(a.minx,b.minx))*greatest(0, least(a.maxy,b.maxy)-greatest(a.miny,b.miny))"


@query(f"SELECT count(*) AS pairs, CAST(sum({AREA}) AS DOUBLE) AS overlap FROM fx_waterbody a JOIN fx_waterbody b ON a.fid<b.fid AND a.maxx>=b.minx AND a.minx<=b.maxx AND a.maxy>=b.miny AND a.miny<=b.maxy", "fx_waterbody")
def self_join_overlap(spark, d):
    tiles = L.boxes(spark, d, "fx_waterbody").select("fid", *X.BOX)
    return X.overlap_pairs(tiles, tiles, 2000.0).filter("fid < r_fid").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("overlap"))


@query(f"SELECT DISTINCT b.fid FROM fx_waterbody b JOIN fx_boundary a ON {AREA} > 0", "fx_waterbody", "fx_boundary")
def filter_area_positive(spark, d):
    return X.overlap_pairs(L.boxes(spark, d, "fx_waterbody").select("fid", *X.BOX), L.boxes(spark, d, "fx_boundary").select(*X.BOX), 2000.0).filter("overlap > 0").select("fid").distinct()


@query(f"SELECT a.fid, CAST((a.maxx-a.minx)*(a.maxy-a.miny) AS DOUBLE) AS total, CAST({AREA} AS DOUBLE) AS inside, round(100.0*{AREA}/nullif((a.maxx-a.minx)*(a.maxy-a.miny),0),6) AS pct FROM fx_boundary a CROSS JOIN (SELECT 401000 AS minx, 301000 AS miny, 405000 AS maxx, 305000 AS maxy) b", "fx_boundary")
def overlay_area(spark, d):
    country = spark.range(1).select(*(F.lit(float(v)).alias(c) for c, v in zip(X.BOX, (401000, 301000, 405000, 305000), strict=True)))
    aoi = L.boxes(spark, d, "fx_boundary").withColumn("total", G.area(F.col("geom")))
    inner = X.overlap_pairs(aoi.select("fid", *X.BOX), country, 2000.0).groupBy("fid").agg(F.sum("overlap").alias("inside"))
    return aoi.join(inner, "fid", "left").select("fid", "total", F.coalesce("inside", F.lit(0.0)).alias("inside"), F.round(F.coalesce(100 * F.try_divide("inside", "total"), F.lit(0.0)), 6).alias("pct"))


# Overlay of polygons


@query(f", s AS (SELECT fid, ox, oy, s FROM fx_shape WHERE shape_kind = 3) SELECT fid, CAST(s*s/2.0 AS DOUBLE) AS own, CAST(s*s/4.0 AS DOUBLE) AS cut, CAST(s*s/4.0 AS DOUBLE) AS rest FROM s", "fx_shape")
def exactness_report(spark, d):
    diamonds = shapes(spark, d).filter("shape_kind = 3")
    halves = diamonds.select("fid", F.col("ox").cast("double").alias("minx"), F.col("oy").cast("double").alias("miny"), (F.col("ox") + F.col("s") / 2).cast("double").alias("maxx"), (F.col("oy") + F.col("s")).cast("double").alias("maxy")).withColumn("geom", G.box_polygon())
    cut = O.overlay(diamonds.select("fid", "geom", *X.BOX), halves, "intersection", same_key=True).select("fid", F.col("area").alias("cut"))
    rest = O.overlay(diamonds.select("fid", "geom", *X.BOX), halves, "difference", same_key=True).select("fid", F.col("area").alias("rest"))
    return diamonds.select("fid", G.area(F.col("geom")).alias("own")).join(cut, "fid").join(rest, "fid")


# Constraints and layers


@query(f", {CONS} SELECT source, count(*) AS n FROM cons GROUP BY 1", *CONS_FX)
def union_constraints(spark, d):
    return L.constraints(spark, d).groupBy("source").agg(F.count("*").alias("n"))


@query(f", {CONS} SELECT source, count(*) AS n FROM cons WHERE source <> 'landcover' GROUP BY 1", *CONS_FX)
def constraints_physical(spark, d):
    return L.constraints(spark, d, land_cover=False).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT fid, 'reconnection' AS source FROM fx_flood WHERE risk_band='Very Low' UNION ALL SELECT fid, 'woodland' FROM fx_shape WHERE shape_kind=1", "fx_flood", "fx_shape")
def union_sources(spark, d):
    return pages.union_layers({"reconnection": fx(spark, d, "fx_flood").filter("risk_band='Very Low'").select("fid"), "woodland": fx(spark, d, "fx_shape").filter("shape_kind=1").select("fid")}, "source")


LEAKY = f", {FLOOD}, {CONS}, mk AS (SELECT minx, miny, maxx, maxy FROM cons UNION ALL SELECT minx, miny, maxx, maxy FROM fx_raf UNION ALL SELECT minx, miny, maxx, maxy FROM fx_flood WHERE risk_band='Low'), kp AS (SELECT * FROM fx_point WHERE fid IN ({inside('fx_point', 'fl')})), lk AS (SELECT * FROM kp WHERE fid NOT IN ({inside('kp', 'mk')}) AND fid IN (SELECT p.fid FROM fx_point p JOIN fx_boundary m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy))"
LEAKY_FX = ("fx_point", "fx_flood", *CONS_FX, "fx_boundary")


def first_in(layer: str, alias: str, columns: dict[str, str], of: str = "lk") -> str:
    firsts = ", ".join(f"min_by(struct_pack(v := {c}), m.fid) AS {n}" for c, n in columns.items())
    return f"{alias} AS (SELECT p.fid AS pid, {firsts} FROM {of} p JOIN {layer} m ON p.x BETWEEN m.minx AND m.maxx AND p.y BETWEEN m.miny AND m.maxy GROUP BY 1)"


SEVEN = ("WB_ID", "WB_NAME", "CEH_LU", "alc_grade", "sl_grp", "sl_tex", "sl_dep", "rch_pt", "prio_hb", "wood_s")


def enriched_sql(of: str = "lk") -> str:
    """CTEs up to ``en``: fid, x, y of ``of`` with the columns of the seven joins."""
    return (
        first_in("fx_waterbody", "e1", {"wb_id": "a1", "wb_name": "a2"}, of) + ", " + first_in("fx_landcover", "e2", {"mode": "a3"}, of) + ", "
        + first_in("fx_grid1k", "e3", {"alc_grade": "a4", "soil_group": "a5", "'TEX' || (m.fid % 3)": "a6", "class": "a9"}, of) + ", " + first_in("(SELECT * FROM fx_grid1k WHERE fid % 3 <> 0)", "e4", {"prioritisation": "a8"}, of) + ", " + first_in("fx_spz", "e5", {"number": "a10"}, of)
        + f", en AS (SELECT fid, x, y, a1.v AS WB_ID, a2.v AS WB_NAME, a3.v AS CEH_LU, a4.v AS alc_grade, a5.v AS sl_grp, a6.v AS sl_tex, CAST(NULL AS VARCHAR) AS sl_dep, a8.v AS rch_pt, a9.v AS prio_hb, a10.v AS wood_s FROM {of} "
        "LEFT JOIN e1 ON e1.pid=fid LEFT JOIN e2 ON e2.pid=fid LEFT JOIN e3 ON e3.pid=fid LEFT JOIN e4 ON e4.pid=fid LEFT JOIN e5 ON e5.pid=fid)"
    )


ENRICHED = LEAKY + ", " + enriched_sql()
ENRICHED_FX = (*LEAKY_FX, "fx_waterbody", "fx_grid1k")  # land cover and zones are among the constraints
CODE = "TRY_CAST(CEH_LU AS INT)"
SUB = [S.sql_case(CODE, S.LAND_COVER_SCORES), S.sql_case("alc_grade", S.GRADE_SCORES), f"coalesce({S.sql_case('prio_hb', S.HABITAT_SCORES)}, 0.5)", S.sql_case("sl_grp", S.SOIL_SCORES), f"coalesce({S.sql_case('rch_pt', S.RECHARGE_SCORES)}, 0.0)"]
SCORED = ENRICHED + ", sc AS (SELECT *, " + ", ".join(f"CAST({s} AS DOUBLE) AS s{i}" for i, s in enumerate(SUB)) + " FROM en)"
COUNT = "(" + " + ".join(f"(CASE WHEN s{i} IS NULL THEN 0 ELSE 1 END)" for i in range(5)) + ")"
MEAN = "round((" + " + ".join(f"coalesce(s{i}, 0)" for i in range(5)) + f")/{COUNT}, 6)"


@query(f"{SCORED} SELECT fid, x, y, WB_ID, WB_NAME, {S.sql_case(CODE, S.LAND_COVER)} AS CEH_LU, {', '.join(SEVEN[3:])}, CAST({COUNT} AS INT) AS n_prio_scores, {MEAN} AS tot_prio FROM sc", *ENRICHED_FX)
def layer_leaky(spark, d):
    return L.leaky_prioritised(spark, d).withColumn("tot_prio", F.round("tot_prio", 6)).drop(*X.BOX)


@query(f"{ENRICHED} SELECT fid, {', '.join(SEVEN)} FROM en", *ENRICHED_FX)
def enrich_seven(spark, d):
    return L.enrich(spark, d, L.leaky(spark, d)).select("fid", *SEVEN)


@query(f", rp AS (SELECT fid, minx+20 AS x, miny+15 AS y FROM fx_raf), {enriched_sql('rp')} SELECT fid, {', '.join(SEVEN)} FROM en", "fx_raf", "fx_waterbody", "fx_landcover", "fx_grid1k", "fx_spz")
def enrich_polygons(spark, d):
    """The seven joins for polygons, by their representative points."""
    return L.enrich(spark, d, L.boxes(spark, d, "fx_raf"), area=L.boxes(spark, d, "fx_boundary")).select("fid", *SEVEN)


GRID_SCORES = f"SELECT fid, {S.sql_case('alc_grade', S.GRADE_SCORES)} AS alc, {S.sql_case('soil_group', S.SOIL_SCORES)} AS sl, {S.sql_case('class', S.HABITAT_SCORES)} AS hb0, {S.sql_case('prioritisation', S.RECHARGE_SCORES)} AS rch0 FROM fx_grid1k"


def grid_scores(spark, d):
    return S.sub_scores(fx(spark, d, "fx_grid1k").select("fid", "alc_grade", F.col("soil_group").alias("sl_grp"), F.col("prioritisation").alias("rch_pt"), F.col("class").alias("prio_hb")))


@query(f"SELECT fid, CAST(alc AS DOUBLE) AS alc_prio, CAST(sl AS DOUBLE) AS sl_prio, CAST(hb0 AS DOUBLE) AS hb_prio FROM ({GRID_SCORES})", "fx_grid1k")
def lookup_scores(spark, d):
    return grid_scores(spark, d).select("fid", "alc_prio", "sl_prio", "hb_prio")


@query(f"SELECT fid, CAST(coalesce(hb0,0.5) AS DOUBLE) AS hb_prio, CAST(coalesce(rch0,0.0) AS DOUBLE) AS rch_prio FROM ({GRID_SCORES})", "fx_grid1k")
def score_nullfill(spark, d):
    return S.filled(grid_scores(spark, d)).select("fid", "hb_prio", "rch_prio")


@query(f"SELECT fid, CAST(CASE WHEN alc IS NULL THEN 0 ELSE 1 END + CASE WHEN sl IS NULL THEN 0 ELSE 1 END + 2 AS INT) AS n_prio_scores, round(CAST(coalesce(alc,0)+coalesce(hb0,0.5)+coalesce(sl,0)+coalesce(rch0,0.0) AS DOUBLE)/(CASE WHEN alc IS NULL THEN 0 ELSE 1 END + CASE WHEN sl IS NULL THEN 0 ELSE 1 END + 2),6) AS tot_prio FROM ({GRID_SCORES})", "fx_grid1k")
def score_mean_skipna(spark, d):
    n, mean = S.mean_skipping_nulls(S.SUB_SCORES)
    return S.filled(grid_scores(spark, d)).select("fid", n.cast("int").alias("n_prio_scores"), F.round(mean, 6).alias("tot_prio"))


@query(f"SELECT fid, CAST(CASE WHEN alc IS NULL THEN 0 ELSE 1 END + CASE WHEN sl IS NULL THEN 0 ELSE 1 END + 2 AS INT) AS n_prio_scores, round(CAST(coalesce(alc,0)+coalesce(hb0,0.5)+coalesce(sl,0)+coalesce(rch0,0.0) AS DOUBLE)/(CASE WHEN alc IS NULL THEN 0 ELSE 1 END + CASE WHEN sl IS NULL THEN 0 ELSE 1 END + 2),6) AS tot_prio FROM ({GRID_SCORES})", "fx_grid1k")
def priority_scores(spark, d):
    df = fx(spark, d, "fx_grid1k").select("fid", "alc_grade", F.col("soil_group").alias("sl_grp"), F.col("prioritisation").alias("rch_pt"), F.col("class").alias("prio_hb"))
    return S.priority_scores(df).select("fid", "n_prio_scores", F.round("tot_prio", 6).alias("tot_prio"))


@query("SELECT CAST(TRY_CAST(mode AS INT) AS VARCHAR) AS value, count(*) AS n FROM fx_landcover WHERE TRY_CAST(mode AS INT) NOT BETWEEN 1 AND 21 GROUP BY 1", "fx_landcover")
def score_unmapped(spark, d):
    return S.unmapped(fx(spark, d, "fx_landcover"), "mode", S.LAND_COVER_SCORES, code=True)


@query(f"SELECT fid, {S.sql_case('TRY_CAST(mode AS INT)', S.LAND_COVER)} AS label FROM fx_landcover", "fx_landcover")
def relabel_landcover(spark, d):
    df = fx(spark, d, "fx_landcover")
    return df.select("fid", S.lookup(S.land_cover_code(df, "mode"), S.LAND_COVER).alias("label"))


@query("SELECT fid, TRY_CAST(mode AS INT) AS code FROM fx_landcover", "fx_landcover")
def numeric_coerce(spark, d):
    df = fx(spark, d, "fx_landcover")
    return df.select("fid", S.land_cover_code(df, "mode").alias("code"))


# Aggregates


@query("SELECT count(*) AS n, CAST(sum((maxx-minx)*(maxy-miny)) AS DOUBLE)/10000 AS ha, CAST(min((maxx-minx)*(maxy-miny)) AS DOUBLE) AS least, round(avg((maxx-minx)*(maxy-miny)),6) AS mean, CAST(max((maxx-minx)*(maxy-miny)) AS DOUBLE) AS most FROM fx_flood", "fx_flood")
def agg_area_total(spark, d):
    a = G.area(F.col("geom"))
    return L.boxes(spark, d, "fx_flood").select(a.alias("a")).agg(F.count("*").alias("n"), (F.sum("a") / 10000).alias("ha"), F.min("a").alias("least"), F.round(F.avg("a"), 6).alias("mean"), F.max("a").alias("most"))


@query("SELECT subsidiary, service_type, CAST(sum((maxx-minx)*(maxy-miny)) AS DOUBLE) AS area FROM fx_boundary GROUP BY 1, 2", "fx_boundary")
def agg_area_by_group(spark, d):
    return L.boxes(spark, d, "fx_boundary").groupBy("subsidiary", "service_type").agg(F.sum(G.area(F.col("geom"))).alias("area"))


@query(f"SELECT lower(trim(number)) AS value, coalesce({SPZ}, false) AS kept, count(*) AS n FROM fx_spz GROUP BY 1, 2", "fx_spz")
def agg_value_counts(spark, d):
    value = F.lower(F.trim("number"))
    return fx(spark, d, "fx_spz").groupBy(value.alias("value"), F.coalesce(value.isin("1", "1c", "2", "2c"), F.lit(False)).alias("kept")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, CAST(sum(a) AS DOUBLE) AS total, CAST(min(a) AS DOUBLE) AS least, CAST(median(a) AS DOUBLE) AS middle, CAST(max(a) AS DOUBLE) AS most FROM (SELECT (maxx-minx)*(maxy-miny) AS a FROM fx_flood)", "fx_flood")
def agg_tile_stats(spark, d):
    return L.boxes(spark, d, "fx_flood").select(G.area(F.col("geom")).alias("a")).agg(F.count("*").alias("n"), F.sum("a").alias("total"), F.min("a").alias("least"), F.percentile("a", 0.5).alias("middle"), F.max("a").alias("most"))


UNEXPECTED = "alc_grade NOT IN ('Grade 1','Grade 2','Grade 3','Grade 4','Grade 5','Urban','Non Agricultural') AND alc_grade NOT IN ('Other','Not Surveyed','')"


@query(f"SELECT alc_grade AS value, count(*) AS n FROM fx_grid1k WHERE {UNEXPECTED} GROUP BY 1", "fx_grid1k")
def agg_unexpected_values(spark, d):
    value = F.col("alc_grade")
    return fx(spark, d, "fx_grid1k").filter(~value.isin(list(S.GRADE_SCORES)) & ~value.isin("Other", "Not Surveyed", "")).groupBy(value.alias("value")).agg(F.count("*").alias("n"))


GRADES = ", ".join(f"'{g}'" for g in S.GRADE_SCORES)


@query(f"SELECT prioritisation AS layer, round(100.0*sum(CASE WHEN alc_grade IS NOT NULL THEN a ELSE 0 END)/nullif(sum(a),0),6) AS graded, round(100.0*sum(CASE WHEN alc_grade IN ({GRADES}) THEN a ELSE 0 END)/nullif(sum(a),0),6) AS scored FROM (SELECT *, (maxx-minx)*(maxy-miny) AS a FROM fx_grid1k) GROUP BY 1", "fx_grid1k")
def agg_coverage_weighted(spark, d):
    return ledger.coverage(L.boxes(spark, d, "fx_grid1k").withColumn("area", G.area(F.col("geom"))), "prioritisation", list(S.GRADE_SCORES)).select(F.col("prioritisation").alias("layer"), F.round("graded", 6).alias("graded"), F.round("scored", 6).alias("scored"))


@query(f"SELECT round(100.0*sum(CASE WHEN alc_grade IN ({GRADES}) THEN a ELSE 0 END)/nullif(sum(a),0),6) AS scored FROM (SELECT *, (maxx-minx)*(maxy-miny) AS a FROM fx_grid1k)", "fx_grid1k")
def agg_coverage_overall(spark, d):
    by = ledger.coverage(L.boxes(spark, d, "fx_grid1k").withColumn("area", G.area(F.col("geom"))), "prioritisation", list(S.GRADE_SCORES))
    return by.agg(F.round(100 * F.sum("scored_area") / F.nullif(F.sum("area"), F.lit(0.0)), 6).alias("scored"))


@query("SELECT w.fid, round(avg(nullif(value, -9999.0)),6) AS mean_value FROM fx_waterbody w LEFT JOIN fx_pixel p ON p.x>=w.minx AND p.x<w.maxx AND p.y>=w.miny AND p.y<w.maxy GROUP BY 1", "fx_waterbody", "fx_pixel")
def zonal_mean(spark, d):
    return X.zonal_mean(fx(spark, d, "fx_pixel"), L.boxes(spark, d, "fx_waterbody"), "value", -9999.0).withColumn("mean_value", F.round("mean_value", 6))


@query(f"{ENRICHED}, c AS (SELECT 'recharge' AS dataset, 'rch_pt' AS \"column\", rch_pt AS value FROM en UNION ALL SELECT 'land cover', 'CEH_LU', CEH_LU FROM en), t AS (SELECT dataset, count(*) AS n, count(value) AS n_hit FROM c GROUP BY 1) SELECT c.dataset, \"column\" AS name, value, n, n_hit, round(100.0*n_hit/n, 6) AS pct, count(*) AS n_value, n_hit = 0 AS no_match FROM c JOIN t ON t.dataset=c.dataset GROUP BY ALL", *ENRICHED_FX)
def enrich_report(spark, d):
    joins = [replace(j, report=j.dataset in ("recharge", "land cover")) for j in L.JOINS]
    rows = report(L.enrich(spark, d, L.leaky(spark, d), joins), joins)
    return rows.withColumnRenamed("column", "name").withColumn("pct", F.round(100 * F.col("n_hit") / F.col("n"), 6))


# Ledger, merge and run control

LEDGER = ("fx_status",)
LATEST = ", lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, layer ORDER BY ts DESC, event_id DESC) AS rn FROM fx_status) WHERE rn = 1)"


@query("SELECT event_id, split_part(status, ':', 1) AS kind, CASE WHEN status LIKE 'error:%' THEN 'FAILED' ELSE 'DONE' END AS state FROM fx_status", *LEDGER)
def tile_status(spark, d):
    return ledger.with_kind(fx(spark, d, "fx_status")).select("event_id", "kind", F.when(F.col("kind") == "error", "FAILED").otherwise("DONE").alias("state"))


@query(f"{LATEST} SELECT layer, count(*) FILTER (status LIKE 'ok:%') AS ok, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status LIKE 'missing:%') AS missing, count(*) FILTER (status LIKE 'error:%') AS error, count(*) FILTER (status = 'skip') AS skip FROM lt GROUP BY 1", *LEDGER)
def agg_layer_status(spark, d):
    return ledger.layer_status(ledger.latest(fx(spark, d, "fx_status")))


@query(f"{LATEST} SELECT tile_id, layer, status FROM lt", *LEDGER)
def marker_merge(spark, d):
    return ledger.latest(fx(spark, d, "fx_status")).select("tile_id", "layer", "status")


@query(f"{LATEST} SELECT wb_id AS tile_id FROM fx_waterbody WHERE wb_id NOT IN (SELECT tile_id FROM lt GROUP BY 1 HAVING count(*) FILTER (status LIKE 'error:%') = 0)", "fx_status", "fx_waterbody")
def tile_todo(spark, d):
    return ledger.todo(fx(spark, d, "fx_waterbody").select(F.col("wb_id").alias("tile_id")), ledger.latest(fx(spark, d, "fx_status")))


@query("SELECT DISTINCT layer FROM fx_status WHERE contains(lower(layer), 'pond') OR contains(lower(layer), 'peat')", *LEDGER)
def tile_refetch(spark, d):
    subs = F.array(F.lit("POND"), F.lit("peat"))
    return fx(spark, d, "fx_status").filter(F.exists(subs, lambda s: F.contains(F.lower("layer"), F.lower(s)))).select("layer").distinct()


SLUG = "regexp_replace(wb_name, '[^A-Za-z0-9]+', '_', 'g')"


@query(f"SELECT fid, CASE WHEN k=0 THEN s ELSE s || '_' || k END AS tile_id FROM (SELECT fid, s, row_number() OVER (PARTITION BY s ORDER BY fid)-1 AS k FROM (SELECT fid, left({SLUG}, 1) AS s FROM fx_waterbody))", "fx_waterbody")
def tile_ids(spark, d):
    return ledger.tile_ids(fx(spark, d, "fx_waterbody").withColumn("name", F.left(F.col("wb_name"), F.lit(1))), "name", "fid").select("fid", "tile_id")


@query("SELECT wb_id FROM (SELECT wb_id, row_number() OVER (ORDER BY wb_id) AS n FROM fx_waterbody WHERE region IN (1, 2)) WHERE n <= 4", "fx_waterbody")
def limit_tiles(spark, d):
    return fx(spark, d, "fx_waterbody").filter(F.col("region").isin(1, 2)).select("wb_id").orderBy("wb_id").limit(4)


@query("SELECT fid, CAST((maxx-minx)*(maxy-miny) AS DOUBLE) AS area FROM fx_flood ORDER BY 2 DESC, 1 LIMIT 5", "fx_flood")
def top_worst(spark, d):
    return L.boxes(spark, d, "fx_flood").select("fid", G.area(F.col("geom")).alias("area")).orderBy(F.desc("area"), "fid").limit(5)


@query("SELECT layer, max(tile_id) AS tile_id FROM (SELECT layer, tile_id, rank() OVER (PARTITION BY layer ORDER BY ts DESC) AS r FROM fx_status) WHERE r=1 GROUP BY 1", *LEDGER)
def newest_output(spark, d):
    return fx(spark, d, "fx_status").groupBy("layer").agg(F.max_by("tile_id", F.struct("ts", "tile_id")).alias("tile_id"))


@query("SELECT tile_id, layer, event_id FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, layer ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS rn FROM fx_status) WHERE rn=1", *LEDGER)
def merge_latest(spark, d):
    return X.newest(fx(spark, d, "fx_status"), ["tile_id", "layer"], [F.to_date("ts").desc(), F.desc("event_id")]).select("tile_id", "layer", "event_id")


@query("SELECT x, y, min(fid) AS fid FROM fx_point GROUP BY 1, 2", "fx_point")
def merge_dedup_points(spark, d):
    return fx(spark, d, "fx_point").groupBy("x", "y").agg(F.min("fid").alias("fid"))


@query(f"{LATEST} SELECT status, count(*) AS n FROM (SELECT split_part(status,':',1) AS status FROM lt) GROUP BY 1", *LEDGER)
def fetch_manifest(spark, d):
    return ledger.with_kind(ledger.latest(fx(spark, d, "fx_status"))).groupBy(F.col("kind").alias("status")).agg(F.count("*").alias("n"))


@query(f"{LATEST} SELECT layer, split_part(status,':',1) AS status, count(*) AS n, CASE WHEN split_part(status,':',1)='error' THEN 'x' WHEN split_part(status,':',1)='missing' THEN '!' ELSE '' END AS mark FROM lt GROUP BY 1, 2", *LEDGER)
def run_index(spark, d):
    kind = ledger.with_kind(ledger.latest(fx(spark, d, "fx_status")))
    return kind.groupBy("layer", F.col("kind").alias("status")).agg(F.count("*").alias("n")).withColumn("mark", F.when(F.col("status") == "error", "x").when(F.col("status") == "missing", "!").otherwise(""))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE status END AS status FROM fx_status", *LEDGER)
def marker_parse(spark, d):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(F.concat(F.lit('{"s": "'), "status", F.lit('"}')))
    return fx(spark, d, "fx_status").select("event_id", F.from_json(text, "map<string,string>")["s"].alias("status"))


# Pages


@query("SELECT dataset, objectid, min(event_id) AS event_id FROM fx_page GROUP BY 1, 2", "fx_page")
def page_dedup_oid(spark, d):
    return pages.dedup(fx(spark, d, "fx_page"), ["dataset", "objectid"], ["page", "event_id"]).select("dataset", "objectid", "event_id")


@query("SELECT dataset, count(*) AS got, CASE dataset WHEN 'ds0' THEN 1 ELSE count(*) END AS expected FROM fx_page WHERE dataset IN ('ds0','ds1') GROUP BY 1 HAVING dataset = 'ds0'", "fx_page")
def page_completeness(spark, d):
    rows = fx(spark, d, "fx_page")
    told = rows.groupBy("dataset").agg(F.count("*").alias("expected")).withColumn("expected", F.when(F.col("dataset") == "ds0", F.lit(1).cast("long")).when(F.col("dataset") == "ds1", F.col("expected")))
    return pages.incomplete(rows, told)


@query("SELECT page, dataset, count(*) AS n FROM fx_page GROUP BY 1, 2 HAVING count(*) = 34", "fx_page")
def page_cap_audit(spark, d):
    return fx(spark, d, "fx_page").groupBy("page", "dataset").agg(F.count("*").alias("n")).filter("n = 34")


CACHE = (
    ", q AS (SELECT dataset AS layer, count(*) AS told FROM fx_page GROUP BY 1), led AS (SELECT DISTINCT dataset AS layer, page*34 AS pos FROM fx_page WHERE page % 10 <> 9), "
    "off AS (SELECT layer, unnest(range(0, told, 34)) AS pos FROM q WHERE layer IN ('ds0', 'ds1') UNION ALL SELECT layer, unnest(range(0, max(pos) + 35, 34)) FROM led WHERE layer = 'ds2' GROUP BY 1), "
    "gap AS (SELECT layer, pos FROM off WHERE layer = 'ds1' OR (layer, pos) NOT IN (SELECT (layer, pos) FROM led))"
)


@query(f"{CACHE} SELECT layer, pos, 'fetch' AS what FROM gap WHERE layer <> 'ds2' UNION ALL SELECT layer, min(pos), 'fetch' FROM gap WHERE layer = 'ds2' GROUP BY 1 UNION ALL SELECT layer, pos, 'stale' FROM led WHERE layer = 'ds1'", "fx_page")
def page_cache_identity(spark, d):
    """Pages were got under three queries, but for every tenth. Since then ds1 has another filter; how many objects ds2 has was never told."""
    rows = fx(spark, d, "fx_page")
    asked = rows.groupBy(F.col("dataset").alias("layer")).agg(F.when(F.first("dataset") != "ds2", F.count("*")).alias("told"))
    asked = asked.withColumns({"box": F.array(*(F.lit(v) for v in L.AREA)), "condition": F.lit(None).cast("string"), "page_size": F.lit(34).cast("long")})
    stored = page_cache.identified(asked).join(rows.select(F.col("dataset").alias("layer"), (F.col("page") * 34).alias("offset"), "page").distinct(), "layer").filter("page % 10 <> 9").select("layer", "identity", "offset")
    now = asked.withColumn("condition", F.when(F.col("layer") == "ds1", "risk = 'High'"))
    return page_cache.missing(now, stored).select("layer", F.col("offset").alias("pos"), F.lit("fetch").alias("what")).unionByName(page_cache.stale(now, stored).select("layer", F.col("offset").alias("pos"), F.lit("stale").alias("what")))


@query("SELECT a.page, a.n AS a, b.n AS b FROM (SELECT page, count(*) FILTER (dataset='ds0' AND page % 5 <> 0) AS n FROM fx_page GROUP BY 1) a JOIN (SELECT page, count(*) FILTER (dataset='ds1') AS n FROM fx_page GROUP BY 1) b ON a.page=b.page WHERE a.n = 0 AND b.n > 0", "fx_page")
def coverage_validity(spark, d):
    by = fx(spark, d, "fx_page").groupBy("page").agg(F.count_if(F.expr("dataset = 'ds0' AND page % 5 <> 0")).alias("a"), F.count_if(F.expr("dataset = 'ds1'")).alias("b"))
    return by.filter("a = 0 AND b > 0").select("page", "a", "b")


# Polygon layers: area of each feature that is left inside the area of interest


@query("SELECT wb_id AS tile_id, wb_id, fid FROM fx_waterbody", "fx_waterbody")
def tile_index(spark, d):
    return ledger.tile_ids(fx(spark, d, "fx_waterbody"), "wb_id", "fid").select("tile_id", "wb_id", "fid")


@query("SELECT fid, CAST((minx+maxx)/2.0 AS DOUBLE) AS x, CAST((miny+maxy)/2.0 AS DOUBLE) AS y FROM fx_spz", "fx_spz")
def rep_point(spark, d):
    return O.representative_points(L.boxes(spark, d, "fx_spz"), "fid")


#: Rings of each kind as they are hashed: anticlockwise, from the least vertex on.
HASHED = [["0 0,1 0,0 1"], ["0 0,1 0,1 0.5,0.5 0.5,0.5 1,0 1"], ["0 0,1 0,1 1,0 1", "0.25 0.25,0.75 0.25,0.75 0.75,0.25 0.75"], ["0 0.5,0.5 0,1 0.5,0.5 1"]]


def hashed_text(kind: list[str]) -> str:
    at = lambda v: f"CAST(CAST(ox+s*{v.split()[0]} AS DOUBLE) AS VARCHAR) || ' ' || CAST(CAST(oy+s*{v.split()[1]} AS DOUBLE) AS VARCHAR)"
    rings = [" || ',' || ".join(at(v) for v in ring.split(",")) for ring in kind]
    return "'polygon|' || " + " || ';' || ".join([*rings, *["''"] * (len(rings) == 1)])


@query("SELECT fid, sha256(CASE shape_kind " + " ".join(f"WHEN {k} THEN {hashed_text(x)}" for k, x in enumerate(HASHED)) + " END) AS hash, 2 AS n FROM fx_shape", "fx_shape")
def geom_hash(spark, d):
    df = fx(spark, d, "fx_shape").select("fid", G.shape_polygon().alias("geom"))
    # The same polygons with rings that run the other way and start at their second vertex.
    turned = F.transform("geom.parts", lambda p: F.transform(p, lambda r: F.reverse(F.concat(F.slice(r, 2, F.size(r) - 1), F.slice(r, 2, 1)))))
    both = df.unionByName(df.select("fid", G.make("polygon", turned).alias("geom")))
    return both.groupBy("fid", G.geometry_hash(F.col("geom")).alias("hash")).agg(F.count("*").cast("int").alias("n"))


DEGREES = "(SELECT c_custkey AS fid, CAST(50 + (c_custkey*53 % 900)/100.0 AS DOUBLE) AS lat, CAST(-6 + (c_custkey*37 % 780)/100.0 AS DOUBLE) AS lon FROM customer)"


@query(f"SELECT fid, round(east, 2) AS east, round(north, 2) AS north FROM {R.grid_sql(DEGREES, 'lat', 'lon')}")
def reproject(spark, d):
    places = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("fid"), F.expr("CAST(50 + (c_custkey*53 % 900)/100.0 AS DOUBLE)").alias("lat"), F.expr("CAST(-6 + (c_custkey*37 % 780)/100.0 AS DOUBLE)").alias("lon"))
    return R.to_grid(places, "lat", "lon").select("fid", F.round("east", 2).alias("east"), F.round("north", 2).alias("north"))


@query("SELECT split_part(status,':',1) AS result, count(*) AS n, round(100.0*count(*)/sum(count(*)) OVER (),6) AS pct FROM fx_status GROUP BY 1", *LEDGER)
def audit_summary(spark, d):
    kind = ledger.with_kind(fx(spark, d, "fx_status"))
    by = kind.groupBy(F.col("kind").alias("result")).agg(F.count("*").alias("n"))
    return by.crossJoin(F.broadcast(kind.agg(F.count("*").alias("t")))).select("result", "n", F.round(100 * F.col("n") / F.col("t"), 6).alias("pct"))


@query("SELECT event_id FROM fx_status WHERE split_part(status,':',1) NOT IN ('ok','empty','skip')", *LEDGER)
def audit_action_items(spark, d):
    return ledger.with_kind(fx(spark, d, "fx_status")).filter(~F.col("kind").isin("ok", "empty", "skip")).select("event_id")


LABELS = {"ok": "reachable", "empty": "reachable, no rows", "error": "broken"}


@query("SELECT event_id, CASE split_part(status,':',1) WHEN 'ok' THEN 'reachable' WHEN 'empty' THEN 'reachable, no rows' WHEN 'error' THEN 'broken' ELSE split_part(status,':',1) END AS label FROM fx_status", *LEDGER)
def probe_label(spark, d):
    return ledger.with_kind(fx(spark, d, "fx_status")).select("event_id", F.coalesce(S.lookup(F.col("kind"), LABELS), F.col("kind")).alias("label"))


GAP = "g AS (SELECT layer AS category, CASE event_id % 3 WHEN 0 THEN 'all' WHEN 1 THEN 'pond,peat' ELSE 'bunds' END AS kinds, event_id % 2 = 0 AS gb FROM fx_status)"


@query(f", {GAP} SELECT t.kind, category, count(*) AS total, count(*) FILTER (gb) AS gb FROM g JOIN (SELECT unnest(['pond','peat','bunds']) AS kind) t ON kinds = 'all' OR list_contains(string_split(kinds, ','), t.kind) GROUP BY 1, 2", *LEDGER)
def audit_gap_matrix(spark, d):
    kinds = F.when(F.col("event_id") % 3 == 0, "all").when(F.col("event_id") % 3 == 1, "pond,peat").otherwise("bunds")
    every = F.array(*(F.lit(k) for k in ("pond", "peat", "bunds")))
    rows = fx(spark, d, "fx_status").select(F.col("layer").alias("category"), F.explode(F.when(kinds == "all", every).otherwise(F.split(kinds, ","))).alias("kind"), (F.col("event_id") % 2 == 0).alias("gb"))
    return rows.groupBy("kind", "category").agg(F.count("*").alias("total"), F.count_if("gb").alias("gb"))


@query("SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 3 IN (0, 1) AND (s_suppkey % 4 = 0 OR s_suppkey % 5 = 0) AND contains(lower(s_name), '1')")
def registry_targets(spark, d):
    df = spark.read.parquet(f"{d}/supplier.parquet")
    method = F.when(F.col("s_suppkey") % 3 == 0, "wfs").when(F.col("s_suppkey") % 3 == 1, "ogc").otherwise("manual")
    phase, experimental, wired = F.when(F.col("s_suppkey") % 4 != 0, "2"), F.col("s_suppkey") % 4 != 0, F.col("s_suppkey") % 5 == 0
    core = F.coalesce(phase, F.lit("1")) == "1"
    return df.filter(method.isin("wfs", "ogc") & (core | (experimental & wired)) & F.contains(F.lower("s_name"), F.lit("1"))).select(F.col("s_suppkey").alias("id"))


# Landed files


def landed(spark, name: str) -> str:
    return f"{storage.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def page_files(spark, d) -> str:
    """Pages of the stand-in as GeoJSON, one a line; pages of ds2 are errors, every tenth page says there is more."""
    rows = fx(spark, d, "fx_page")
    feature = F.struct(F.col("objectid").alias("id"), F.create_map(F.lit("dataset"), "dataset").alias("properties"), F.lit('{"type":"Point"}').alias("geometry"))
    by = rows.groupBy("dataset", "page").agg(F.collect_list(feature).alias("features"))
    kind = F.when(F.col("dataset") == "ds2", "ExceptionReport").otherwise("FeatureCollection")
    body = by.select(F.to_json(F.struct(kind.alias("type"), F.struct((F.col("page") % 10 == 0).alias("exceededTransferLimit")).alias("properties"), "features")).alias("value"))
    path = landed(spark, "geojson")
    body.write.text(path)
    return path


@query("SELECT dataset, objectid, count(*) AS n FROM fx_page WHERE dataset <> 'ds2' GROUP BY 1, 2", "fx_page")
def scan_geojson_pages(spark, d):
    return landing.geojson_pages(spark, page_files(spark, d)).groupBy(F.col("properties")["dataset"].alias("dataset"), F.col("id").alias("objectid")).agg(F.count("*").alias("n"))


@query("SELECT dataset, objectid, count(*) AS n, CAST(sum(objectid % 1000) AS DOUBLE) AS xs, CAST(2*count(*) AS BIGINT) AS vertices FROM fx_page WHERE dataset <> 'ds2' GROUP BY 1, 2", "fx_page")
def scan_gml_pages(spark, d):
    rows = fx(spark, d, "fx_page")
    member = F.format_string('<wfs:member><ms:feature gml:id="f%d"><ms:objectid>%d</ms:objectid><ms:dataset>%s</ms:dataset><gml:posList>%d 0 0 5</gml:posList></ms:feature></wfs:member>', "objectid", "objectid", "dataset", F.col("objectid") % 1000)
    by = rows.groupBy("dataset", "page").agg(F.array_join(F.collect_list(member), "").alias("members"))
    head = '<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:gml="http://www.opengis.net/gml/3.2" xmlns:ms="http://x/">'
    body = F.when(F.col("dataset") == "ds2", F.lit("<ows:ExceptionReport>busy</ows:ExceptionReport>")).otherwise(F.concat(F.lit(head), "members", F.lit("</wfs:FeatureCollection>")))
    path = landed(spark, "gml")
    by.select(body.alias("value")).write.text(path)  # a line a page, so that files grow in size and not in number
    found = landing.gml_features(spark, path)
    return found.groupBy("dataset", "objectid").agg(F.count("*").alias("n"), F.sum(F.get("vertices", F.lit(0))["x"]).alias("xs"), F.sum(F.size("vertices")).alias("vertices"))


@query("SELECT count(*) AS more FROM (SELECT DISTINCT dataset, page FROM fx_page WHERE page % 10 = 0)", "fx_page")
def scan_arcgis_pages(spark, d):
    return landing.cut_off(spark, page_files(spark, d)).agg(F.count("*").alias("more"))


@query("SELECT fid, risk_band FROM fx_flood WHERE risk_band='High'", "fx_flood")
def write_stage(spark, d):
    df = fx(spark, d, "fx_flood").filter("risk_band='High'").select("fid", "risk_band")
    path = landed(spark, "stages")
    landing.write_stage(df.limit(0), path, "flood", "opportunity", "2024-01-01")
    return spark.read.parquet(landing.write_stage(df, path, "flood", "opportunity", "2024-01-01"))


@query("SELECT fid, risk_band FROM fx_flood WHERE risk_band='none'", "fx_flood")
def write_empty_ok(spark, d):
    df = fx(spark, d, "fx_flood").filter("risk_band='none'").select("fid", "risk_band")
    return spark.read.parquet(landing.write_stage(df, landed(spark, "stages"), "flood", "empty", "2024-01-01"))


@query("SELECT dataset, count(DISTINCT objectid) AS n, CASE dataset WHEN 'ds1' THEN count(DISTINCT objectid) + 1 WHEN 'ds0' THEN count(DISTINCT objectid) END AS expected, CASE dataset WHEN 'ds1' THEN 'open' ELSE 'closed' END AS state, count(DISTINCT page) AS pages FROM fx_page GROUP BY 1", "fx_page")
def ingest_pages_stream(spark, d):
    """Two runs of the stream, the second of which takes up where the first ended; ds1 was told to have one object more, ds2 told nothing."""
    rows, path = fx(spark, d, "fx_page").select("dataset", "page", "objectid"), landed(spark, "landing")
    table, state = landed(spark, "ingested"), landed(spark, "stream")
    for part in ("page % 2 = 0", "page % 2 = 1"):
        rows.filter(part).write.mode("append").json(path)
        landing.ingest_stream(spark, path, table, state)
    got = landing.ingested(spark, table)
    told = rows.groupBy("dataset").agg((F.count_distinct("objectid") + F.when(F.first("dataset") == "ds1", 1).otherwise(0)).alias("expected")).filter("dataset <> 'ds2'")
    pages_got = got.groupBy("dataset").agg(F.count_distinct("page").alias("pages"))
    return landing.load_state(got, told).join(pages_got, "dataset")


TILED = "SELECT fid, risk_band, concat('t', CAST(fid % 7 AS VARCHAR)) AS tile_id FROM fx_flood WHERE risk_band='High'"


@query(f"SELECT t.tile_id, CASE t.tile_id WHEN 't6' THEN 0 ELSE count(u.fid) END AS n, CAST(CASE WHEN t.tile_id IN ('t1', 't6') THEN 2 ELSE 1 END AS BIGINT) AS runs, CASE t.tile_id WHEN 't6' THEN 'empty' ELSE concat('ok:', CAST(count(u.fid) AS VARCHAR)) END AS status FROM ({TILED}) t LEFT JOIN ({TILED}) u ON u.fid = t.fid AND (t.tile_id <> 't1' OR t.fid % 2 = 0) GROUP BY 1", "fx_flood")
def write_tiles(spark, d):
    """All tiles are written, then two of them anew: t1 with half of its rows, t6 with none. The others' rows stay."""
    df = fx(spark, d, "fx_flood").filter("risk_band='High'").select("fid", "risk_band", F.concat(F.lit("t"), (F.col("fid") % 7).cast("string")).alias("tile_id"))
    path, book = landed(spark, "tiles"), landed(spark, "tile-ledger")
    run = lambda rows, tiles: landing.write_tiles(rows, tiles, path, book, "flood", "opportunity", "2024-01-01")
    run(df, df.select("tile_id").distinct())
    run(df.filter("tile_id = 't1' AND fid % 2 = 0"), spark.sql("SELECT explode(array('t1', 't6')) AS tile_id"))
    state = spark.read.parquet(book).groupBy("tile_id").agg(F.count("*").alias("runs"), F.max_by("status", "at").alias("status"))
    n = landing.read_tiles(spark, path, df.schema).groupBy("tile_id").agg(F.count("*").alias("n"))
    return state.join(n, "tile_id", "left").select("tile_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "runs", "status")


@query(f", rp AS (SELECT fid, minx AS x, miny AS y FROM fx_spz), {enriched_sql('rp')} SELECT fid, alc_grade, CAST(NULL AS VARCHAR) AS sl_grp, CAST(NULL AS VARCHAR) AS rch_pt, CAST(NULL AS VARCHAR) AS no_such FROM en", "fx_spz", "fx_waterbody", "fx_landcover", "fx_grid1k")
def enrich_on_fail(spark, d):
    """A dataset that can't be loaded and one that only warns give nulls, and so does one without coverage on a tile; the others are joined."""
    points = fx(spark, d, "fx_spz").select("fid", F.col("minx").alias("x"), F.col("miny").alias("y"))
    joins = [Join("unknown", rename={"SOIL_GROUP": "sl_grp"}), Join("recharge", column_match={"prioriti": "rch_pt"}, on_fail="raise"), Join("agricultural land", rename={"alc_grade": "alc_grade", "other": "no_such"})]
    far = L.area_of_interest(spark).withColumns({c: F.col(c) + 1e6 for c in X.BOX})
    return L.enrich(spark, d, points, joins, area=far, tile=True).drop("x", "y")
