"""Registered queries whose results are polygons, and SQL that finds the same ones on a lattice.

All corners of the stand-in boxes, L-shapes and frames are multiples of ``STEP`` metres, so SQL can count lattice cells: areas are cells, parts are
cells connected by sides, and a lattice point is a vertex of a ring if one, three or two opposite cells around it are kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures
from ..functions import geometry as G
from ..operators import buffer, checks, repair, tiles, touch
from ..operators import overlay as O
from ..operators import spatial as X
from ..operators.storage import shared_dir, written
from ..sources import silver
from . import layers as L
from .registry import ORACLE_SQL, query

fx = fixtures.layer


def told(df: DataFrame, *columns: str, apart: bool = False) -> DataFrame:
    """What SQL can tell of polygons: columns, area, parts, holes, vertices and all vertices in order.

    Holes of a part that meet each other in a corner are one, and those that meet its outside so are none, as cells tell them; rings (``apart``) count each.
    """
    corner = lambda v: F.concat_ws(" ", v["x"].cast("long").cast("string"), v["y"].cast("long").cast("string"))
    opened = lambda p: F.flatten(F.transform(p, lambda r: F.slice(r, 1, F.size(r) - 1)))
    once = F.transform(F.flatten(F.transform("geom.parts", opened)), corner)
    holes = lambda p: F.size(p) - 1 if apart else F.size(p) - 1 - F.size(opened(p)) + F.size(F.array_distinct(opened(p)))
    n_holes = F.aggregate("geom.parts", F.lit(0).cast("long"), lambda n, p: n + holes(p))
    return df.select(*columns, "area", F.size("geom.parts").cast("long").alias("n_parts"), n_holes.alias("n_holes"), F.size(once).cast("long").alias("n_vertices"), F.array_join(F.array_sort(once), ",").alias("corners"))


def cells_of(boxes: str, step: int) -> str:
    """Rows (g, x, y): distinct lattice cells of boxes (g, minx .. maxy) by group."""
    span = lambda lo, hi: f"unnest(range(CAST({lo} AS BIGINT) // {step}, CAST({hi} AS BIGINT) // {step}))"
    return f"SELECT DISTINCT g, x, {span('miny', 'maxy')} AS y FROM (SELECT g, miny, maxy, {span('minx', 'maxx')} AS x FROM ({boxes}))"


def told_sql(step: int, labelled: str = "lab") -> str:
    """CTEs from ``lab`` (g, part, x, y) on: ``res`` (g, area, n_parts, n_holes, n_vertices, corners), for each g."""
    return (
        f"pts AS (SELECT g, part, px, py, sum(bit) AS m FROM (SELECT g, part, x + dx AS px, y + dy AS py, bit FROM {labelled}, (VALUES (0,0,1),(1,0,2),(0,1,4),(1,1,8)) q(dx, dy, bit)) GROUP BY ALL), "
        f"vert AS (SELECT g, px, py FROM pts WHERE m IN (1,2,4,8,7,11,13,14,6,9) UNION ALL SELECT g, px, py FROM pts WHERE m IN (6,9)), "
        f"vs AS (SELECT g, count(*) AS n_vertices, string_agg(v, ',' ORDER BY v) AS corners FROM (SELECT g, (px*{step})::VARCHAR || ' ' || (py*{step})::VARCHAR AS v FROM vert) GROUP BY g), "
        # Euler's number of a part of cells that are connected by sides: cells - inner sides + inner points; 1 less for each hole.
        f"eu AS (SELECT g, sum(f) AS f FROM (SELECT g, count(*) AS f FROM {labelled} GROUP BY g UNION ALL SELECT a.g, -count(*) FROM {labelled} a JOIN {labelled} b ON a.g=b.g AND a.part=b.part AND a.y=b.y AND b.x=a.x+1 GROUP BY 1 "
        f"UNION ALL SELECT a.g, -count(*) FROM {labelled} a JOIN {labelled} b ON a.g=b.g AND a.part=b.part AND a.x=b.x AND b.y=a.y+1 GROUP BY 1 UNION ALL SELECT g, count(*) FROM pts WHERE m=15 GROUP BY 1) GROUP BY g), "
        f"ar AS (SELECT g, CAST(count(*)*{step * step} AS DOUBLE) AS area, count(DISTINCT part) AS n_parts FROM {labelled} GROUP BY g), "
        "res AS (SELECT ar.g, area, n_parts, CAST(n_parts - f AS BIGINT) AS n_holes, n_vertices, corners FROM ar JOIN vs ON vs.g=ar.g JOIN eu ON eu.g=ar.g)"
    )


def labelled_sql(cells: str) -> str:
    """CTEs ``cell`` and ``lab``: cells (g, x, y) with the least cell of those that they are connected with by sides."""
    return (
        f"cell AS (SELECT *, (g*1000000 + x)*2000000 + y AS id FROM ({cells})), nb AS (SELECT a.id AS p, unnest([a.id + 1, a.id - 1, a.id + 2000000, a.id - 2000000]) AS q FROM cell a), "
        "cc(id, part) USING KEY (id) AS (SELECT id, id FROM cell UNION SELECT was.id, min(now.part) FROM recurring.cc AS was JOIN nb ON nb.p = was.id JOIN cc AS now ON now.id = nb.q WHERE now.part < was.part GROUP BY was.id), "
        "lab AS (SELECT g, part, x, y FROM cell JOIN cc USING (id))"
    )


def with_recursive(head: str, rest: str) -> str:
    return head.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", " + rest


# Overlay of a layer and a mask

STEP = 10
HIGH = "SELECT fid AS g, minx, miny, maxx, maxy FROM fx_flood WHERE risk_band='High'"
RAF = "SELECT 0 AS g, minx, miny, maxx, maxy FROM fx_raf"


def overlay_sql(cells: str, select: str) -> str:
    return with_recursive(fixtures.cte("fx_flood", "fx_raf"), f"f AS ({cells_of(HIGH, STEP)}), m AS ({cells_of(RAF, STEP)}), {labelled_sql(cells)}, {told_sql(STEP)} {select}")


def raf_overlay(spark, d, kind, **options):
    high = L.boxes(spark, d, "fx_flood").filter("risk_band = 'High'")
    return O.overlay(high, L.boxes(spark, d, "fx_raf"), kind, **options)


SHAPED = "area, n_parts, n_holes, n_vertices, corners"


@query()
def subtract_polys(spark, d):
    return told(raf_overlay(spark, d, "difference", min_area=500.0), "fid", "risk_band")


ORACLE_SQL["subtract_polys"] = overlay_sql("SELECT * FROM f ANTI JOIN m USING (x, y)", f"SELECT g AS fid, 'High' AS risk_band, {SHAPED} FROM res WHERE area >= 500")


@query()
def keep_within_polys(spark, d):
    return told(raf_overlay(spark, d, "intersection"), "fid", "risk_band")


ORACLE_SQL["keep_within_polys"] = overlay_sql("SELECT * FROM f SEMI JOIN m USING (x, y)", f"SELECT g AS fid, 'High' AS risk_band, {SHAPED} FROM res")


@query()
def spatial_overlay(spark, d):
    return told(raf_overlay(spark, d, "union"), "fid", "risk_band")


ORACLE_SQL["spatial_overlay"] = overlay_sql(
    "SELECT * FROM f UNION SELECT DISTINCT b.fid AS g, x, y FROM (SELECT fid, unnest(range(CAST(rx AS BIGINT)//10, CAST(rx2 AS BIGINT)//10)) AS x, ry, ry2 FROM (SELECT h.g AS fid, r.minx AS rx, r.miny AS ry, r.maxx AS rx2, r.maxy AS ry2 FROM "
    f"({HIGH}) h JOIN fx_raf r ON h.maxx>r.minx AND h.minx<r.maxx AND h.maxy>r.miny AND h.miny<r.maxy)) b, LATERAL (SELECT unnest(range(CAST(ry AS BIGINT)//10, CAST(ry2 AS BIGINT)//10)) AS y)",
    f"SELECT g AS fid, 'High' AS risk_band, {SHAPED} FROM res",
)


@query()
def clip_aoi_polys(spark, d):
    """Polygons inside the union of the boundary's components."""
    high = L.boxes(spark, d, "fx_flood").filter("risk_band = 'High'")
    return told(O.overlay(high, L.boxes(spark, d, "fx_boundary"), "intersection"), "fid")


ORACLE_SQL["clip_aoi_polys"] = with_recursive(
    fixtures.cte("fx_flood", "fx_boundary"), f"f AS ({cells_of(HIGH, STEP)}), m AS ({cells_of('SELECT 0 AS g, minx, miny, maxx, maxy FROM fx_boundary', STEP)}), {labelled_sql('SELECT * FROM f SEMI JOIN m USING (x, y)')}, {told_sql(STEP)} SELECT g AS fid, {SHAPED} FROM res"
)


@query()
def union_geom(spark, d):
    """Outline of each region's tiles."""
    return told(O.union(L.boxes(spark, d, "fx_waterbody"), "region"), "region")


ORACLE_SQL["union_geom"] = with_recursive(fixtures.cte("fx_waterbody"), f"{labelled_sql(cells_of('SELECT region AS g, minx, miny, maxx, maxy FROM fx_waterbody', 100))}, {told_sql(100)} SELECT g AS region, {SHAPED} FROM res")


@query()
def aoi_waterbody_union(spark, d):
    """Whole tiles that the boundary overlaps, as one polygon."""
    tiles = L.boxes(spark, d, "fx_waterbody")
    return told(L.aoi_union(tiles, L.boxes(spark, d, "fx_boundary")))


ORACLE_SQL["aoi_waterbody_union"] = with_recursive(
    fixtures.cte("fx_waterbody", "fx_boundary"),
    f"w AS (SELECT 0 AS g, w.* FROM fx_waterbody w WHERE EXISTS (SELECT 1 FROM fx_boundary a WHERE least(a.maxx,w.maxx) > greatest(a.minx,w.minx) AND least(a.maxy,w.maxy) > greatest(a.miny,w.miny))), {labelled_sql(cells_of('SELECT g, minx, miny, maxx, maxy FROM w', 100))}, {told_sql(100)} SELECT {SHAPED} FROM res",
)


# Clusters of boxes, L-shapes and frames that meet


def mixed(spark, d) -> DataFrame:
    """High flood boxes, L-shapes and square frames; fids are told apart by their remainder modulo 3."""
    shape = L.shapes(spark, d)
    parts = [L.boxes(spark, d, "fx_flood").filter("risk_band = 'High'"), shape.filter("shape_kind = 1"), shape.filter("shape_kind = 2")]
    rows = [p.select((F.col("fid") * 3 + i).alias("fid"), "geom", *X.BOX) for i, p in enumerate(parts)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


MIXED_FX = ("fx_flood", "fx_shape")
#: The same polygons as boxes: L-shapes are two, frames four.
MIXED = (
    "mixed AS (SELECT fid*3 AS g, minx, miny, maxx, maxy FROM fx_flood WHERE risk_band='High' UNION ALL SELECT fid*3+1, ox, oy, ox+s, oy+s//2 FROM fx_shape WHERE shape_kind=1 UNION ALL SELECT fid*3+1, ox, oy, ox+s//2, oy+s FROM fx_shape WHERE shape_kind=1 "
    + "".join(f"UNION ALL SELECT fid*3+2, ox+s*{a}//4, oy+s*{b}//4, ox+s*{c}//4, oy+s*{e}//4 FROM fx_shape WHERE shape_kind=2 " for a, b, c, e in ((0, 0, 4, 1), (0, 3, 4, 4), (0, 0, 1, 4), (3, 0, 4, 4)))
    + "), touch AS (SELECT DISTINCT a.g AS a, b.g AS b FROM mixed a JOIN mixed b ON a.g<b.g AND a.maxx>=b.minx AND a.minx<=b.maxx AND a.maxy>=b.miny AND a.miny<=b.maxy)"
)
CLUSTERS = (
    "paired AS (SELECT a, b FROM touch UNION ALL SELECT b, a FROM touch), cl(id, root) USING KEY (id) AS (SELECT DISTINCT g, g FROM mixed UNION SELECT was.id, min(now.root) FROM recurring.cl AS was JOIN paired ON paired.a = was.id JOIN cl AS now ON now.id = paired.b WHERE now.root < was.root GROUP BY was.id)"
)


@query(f", {MIXED} SELECT a, b FROM touch", *MIXED_FX)
def touch_pairs(spark, d):
    return touch.touching_polygons(mixed(spark, d))


def clusters(spark, d) -> tuple[DataFrame, DataFrame]:
    polygons = mixed(spark, d)
    return polygons, touch.clusters(polygons)


@query()
def connected_components(spark, d):
    return clusters(spark, d)[1].select(F.col("node").alias("fid"), "root")


ORACLE_SQL["connected_components"] = with_recursive(fixtures.cte(*MIXED_FX), f"{MIXED}, {CLUSTERS} SELECT id AS fid, root FROM cl")


@query()
def dissolve_connected(spark, d):
    polygons, roots = clusters(spark, d)
    return told(O.dissolve(polygons, written(roots, "cluster-roots")), "root", *X.BOX).drop("n_parts")


#: Boxes that overlap or share some of a side are of one part; each cell of a part is labelled with its least box.
PARTED = (
    "box AS (SELECT row_number() OVER (ORDER BY g, minx, miny, maxx, maxy) AS b, root, mixed.* FROM mixed JOIN cl ON id = g), side AS (SELECT a.b AS p, b.b AS q FROM box a JOIN box b ON a.root=b.root AND a.b<>b.b AND a.maxx>=b.minx AND a.minx<=b.maxx AND a.maxy>=b.miny AND a.miny<=b.maxy "
    "AND ((a.maxx>b.minx AND a.minx<b.maxx) OR (a.maxy>b.miny AND a.miny<b.maxy))), pt(id, part) USING KEY (id) AS (SELECT b, b FROM box UNION SELECT was.id, min(now.part) FROM recurring.pt AS was JOIN side ON side.p = was.id JOIN pt AS now ON now.id = side.q WHERE now.part < was.part GROUP BY was.id)"
)
ORACLE_SQL["dissolve_connected"] = with_recursive(
    fixtures.cte(*MIXED_FX),
    f"{MIXED}, {CLUSTERS}, {PARTED}, lab AS (SELECT g, 0 AS part, x, y FROM ({cells_of('SELECT part AS g, minx, miny, maxx, maxy FROM box JOIN pt ON id = b', 5)})), {told_sql(5)}, whole AS (SELECT part AS g, any_value(root) AS root, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM box JOIN pt ON id = b GROUP BY 1) "
    "SELECT root, CAST(minx AS DOUBLE) AS minx, CAST(miny AS DOUBLE) AS miny, CAST(maxx AS DOUBLE) AS maxx, CAST(maxy AS DOUBLE) AS maxy, area, n_holes, n_vertices, corners FROM whole JOIN res USING (g)",
)


# Two layers compared


IOU_CELLS = f"a AS ({cells_of('SELECT 0 AS g, minx, miny, maxx, maxy FROM fx_flood WHERE risk_band IN (\'High\',\'Medium\')', STEP)}), b AS ({cells_of(RAF, STEP)})"


@query(f", {IOU_CELLS} SELECT shared/(n+m-shared) AS iou, shared*100.0::DOUBLE AS shared, n*100.0::DOUBLE AS area_left, m*100.0::DOUBLE AS area_right FROM (SELECT (SELECT count(*) FROM a SEMI JOIN b USING (x, y)) AS shared, (SELECT count(*) FROM a) AS n, (SELECT count(*) FROM b) AS m)", "fx_flood", "fx_raf")
def agg_iou(spark, d):
    """Two layers that differ and overlap among themselves."""
    return O.iou(L.boxes(spark, d, "fx_flood").filter("risk_band IN ('High', 'Medium')"), L.boxes(spark, d, "fx_raf"))


# Validity, repair and division


def broken(spark, d) -> DataFrame:
    """Shapes, each with its key doubled, and beside them bow-ties (kind 3) and squares with overlapping holes (kind 2), which aren't valid."""
    shape = fx(spark, d, "fx_shape")

    def drawn(*rings):
        at = lambda a, b: G.vertex(F.col("ox") + F.col("s") * a, F.col("oy") + F.col("s") * b)
        return G.make("polygon", F.array(F.array(*(F.array(*(at(*p) for p in [*r, r[0]])) for r in rings))))

    square = lambda a, s: [(a, a), (a + s, a), (a + s, a + s), (a, a + s)]
    bow, holed = drawn([(0, 0), (1, 1), (1, 0), (0, 1)]), drawn(square(0, 1), square(0.25, 0.5), square(0.5, 0.375))
    bad = shape.filter("shape_kind >= 2").select((F.col("fid") * 2 + 1).alias("fid"), F.when(F.col("shape_kind") == 3, bow).otherwise(holed).alias("geom"))
    return G.with_bounds(shape.select((F.col("fid") * 2).alias("fid"), G.shape_polygon().alias("geom")).unionByName(bad))


#: Area and vertices of ``broken`` once it is repaired: two triangles; a square less the union of its holes.
REPAIRED = (
    "rep AS (SELECT fid*2 AS fid, CAST(CASE shape_kind WHEN 0 THEN s*s/2.0 WHEN 3 THEN s*s/2.0 ELSE 0.75*s*s END AS DOUBLE) AS area, CASE shape_kind WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 8 ELSE 4 END AS n_vertices, 1 AS n_parts, false AS fixed FROM fx_shape "
    "UNION ALL SELECT fid*2+1, CAST(CASE shape_kind WHEN 3 THEN s*s/2.0 ELSE 0.671875*s*s END AS DOUBLE), CASE shape_kind WHEN 3 THEN 6 ELSE 12 END, CASE shape_kind WHEN 3 THEN 2 ELSE 1 END, true FROM fx_shape WHERE shape_kind >= 2)"
)


def sized(df: DataFrame) -> DataFrame:
    rings = F.flatten("geom.parts")
    return df.select("fid", F.round(G.area(F.col("geom")), 6).alias("area"), (G.num_coords(F.col("geom")) - F.size(rings)).alias("n_vertices"), F.size("geom.parts").alias("n_parts"))


@query(f", {REPAIRED} SELECT fid, NOT fixed AS is_valid FROM rep", "fx_shape")
def is_valid(spark, d):
    return repair.validity(broken(spark, d), "fid").select("fid", "is_valid")


@query(f", {REPAIRED} SELECT fid, area, n_vertices, n_parts FROM rep", "fx_shape")
def make_valid(spark, d):
    return sized(repair.make_valid(broken(spark, d)))


@query(f", {REPAIRED} SELECT fid, area, n_vertices, n_parts, true AS again, (SELECT count(*) FROM rep) AS n_rows, (SELECT count(*) FROM rep WHERE fixed) AS n_fixed FROM rep", "fx_shape")
def validate_once(spark, d):
    """The table that a first run leaves; a second one reads it and writes nothing."""
    at = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    broken(spark, d).write.parquet(f"{at}/bronze")
    first = silver.validate_once(spark, f"{at}/bronze", f"{at}/silver")
    again = silver.validate_once(spark, f"{at}/bronze", f"{at}/silver")
    said = silver.committed(spark, f"{at}/silver")
    return sized(spark.read.parquet(again)).select("*", F.lit(first == again).alias("again"), F.lit(said["n_rows"]).cast("long").alias("n_rows"), F.lit(said["n_fixed"]).cast("long").alias("n_fixed"))


def halved(kind: int, x: str, y: str, w: str, h: str) -> str:
    return f"SELECT fid, CAST(ox+s*{x} AS DOUBLE) AS minx, CAST(oy+s*{y} AS DOUBLE) AS miny, CAST(ox+s*({x}+{w}) AS DOUBLE) AS maxx, CAST(oy+s*({y}+{h}) AS DOUBLE) AS maxy, CAST(s*s*{w}*{h} AS DOUBLE) AS area, 5 AS n FROM fx_shape WHERE shape_kind={kind}"


#: With six vertices at most, L-shapes fall into two boxes and frames into eight: at half height, at half width, at a quarter of the height.
HALVED = [halved(1, "0", "0", "1", "0.5"), halved(1, "0", "0.5", "0.5", "0.5")] + [
    halved(2, x, y, w, "0.25") for row in ((("0", "0", "0.5"), ("0.5", "0", "0.5"), ("0", "0.25", "0.25"), ("0.75", "0.25", "0.25")), (("0", "0.5", "0.25"), ("0.75", "0.5", "0.25"), ("0", "0.75", "0.5"), ("0.5", "0.75", "0.5"))) for x, y, w in row
]


@query("SELECT fid, CAST(ox AS DOUBLE) AS minx, CAST(oy AS DOUBLE) AS miny, CAST(ox+s AS DOUBLE) AS maxx, CAST(oy+s AS DOUBLE) AS maxy, CAST(s*s/2.0 AS DOUBLE) AS area, CASE shape_kind WHEN 0 THEN 4 ELSE 5 END AS n FROM fx_shape WHERE shape_kind IN (0, 3) UNION ALL " + " UNION ALL ".join(HALVED), "fx_shape")
def subdivide(spark, d):
    return repair.subdivide(L.shapes(spark, d), most=6).select("fid", *X.BOX, F.round(G.area(F.col("geom")), 6).alias("area"), G.num_coords(F.col("geom")).alias("n"))


# Layers: sources less their masks, in the area of interest, as single polygons

CONS = (
    "cons AS (SELECT minx, miny, maxx, maxy, true AS cover FROM fx_landcover WHERE mode IN ('20','21','11','1') UNION ALL SELECT minx, miny, maxx, maxy, false FROM fx_spz WHERE lower(trim(number)) IN ('1','1c','2','2c')"
    " UNION ALL SELECT x1-10, y1-10, x2+10, y2+10, false FROM fx_line WHERE fid % 2 = 1 UNION ALL SELECT x1-20, y1-20, x2+20, y2+20, false FROM fx_line WHERE fid % 10 = 0 UNION ALL SELECT minx, miny, maxx, maxy, false FROM fx_raf WHERE fid % 15 = 0)"
)
LAYER_FX = ("fx_landcover", "fx_spz", "fx_line", "fx_raf", "fx_flood", "fx_shape")
BUFFERED = "SELECT x1-r, y1-r, x2+r, y2+r FROM (SELECT *, CASE type WHEN 'District' THEN 50 WHEN 'Local' THEN 30 WHEN 'National' THEN 150 WHEN 'Regional' THEN 100 END AS r FROM fx_line) WHERE r IS NOT NULL"


def layer_sql(boxes: str, mask: str = "SELECT minx, miny, maxx, maxy FROM cons", step: int = STEP, least: int = 0) -> str:
    """Lattice cells of the sources that the area of interest holds and no mask covers, and the parts that they make."""
    a, b, c, e = (int(v) for v in L.AREA)
    inside = f"x >= {a}//{step} AND x < {c}//{step} AND y >= {b}//{step} AND y < {e}//{step}"
    kept = f"SELECT g, x, y FROM ({cells_of(f'SELECT 0 AS g, minx, miny, maxx, maxy FROM ({boxes})', step)}) f WHERE {inside} AND NOT EXISTS (SELECT 1 FROM mk WHERE mk.x = f.x AND mk.y = f.y)"
    masked = cells_of(f"SELECT 0 AS g, minx, miny, maxx, maxy FROM ({mask}) t(minx, miny, maxx, maxy)", step)
    return with_recursive(
        fixtures.cte(*LAYER_FX),
        f"{CONS}, mk AS ({masked}), {labelled_sql(kept).replace('lab AS (', 'lab0 AS (')}, lab AS (SELECT dense_rank() OVER (ORDER BY part) AS g, 0 AS part, x, y FROM lab0), {told_sql(step)}, "
        f"ext AS (SELECT g, CAST(min(x)*{step} AS DOUBLE) AS minx, CAST(min(y)*{step} AS DOUBLE) AS miny FROM lab GROUP BY 1) SELECT minx, miny, area, n_holes, n_vertices, corners FROM ext JOIN res USING (g) WHERE area >= {least}",
    )


def layer(spark, d, name):
    return told(L.opportunity(spark, d, name), "minx", "miny").drop("n_parts")


@query()
def layer_pond(spark, d):
    return layer(spark, d, "pond")


@query()
def layer_bunds(spark, d):
    return layer(spark, d, "bunds")


@query()
def layer_floodplain(spark, d):
    return layer(spark, d, "floodplain")


@query()
def layer_riparian(spark, d):
    return layer(spark, d, "riparian")


FLOODED = "SELECT minx, miny, maxx, maxy FROM fx_flood WHERE risk_band"
ORACLE_SQL["layer_pond"] = layer_sql("SELECT minx, miny, maxx, maxy FROM fx_raf")
ORACLE_SQL["layer_bunds"] = layer_sql(f"{FLOODED} IN ('High','Medium')", f"SELECT minx, miny, maxx, maxy FROM cons UNION ALL SELECT minx, miny, maxx, maxy FROM fx_raf UNION ALL {BUFFERED}", least=20)
ORACLE_SQL["layer_floodplain"] = layer_sql(f"{FLOODED}='Very Low' UNION ALL SELECT ox, oy, ox+s, oy+s//2 FROM fx_shape WHERE shape_kind=1 UNION ALL SELECT ox, oy, ox+s//2, oy+s FROM fx_shape WHERE shape_kind=1")
ORACLE_SQL["layer_riparian"] = layer_sql(" UNION ALL ".join(f"SELECT ox+s*{a}//4 AS minx, oy+s*{b}//4 AS miny, ox+s*{c}//4 AS maxx, oy+s*{e}//4 AS maxy FROM fx_shape WHERE shape_kind=2" for a, b, c, e in ((0, 0, 4, 1), (0, 3, 4, 4), (0, 0, 1, 4), (3, 0, 4, 4))), step=5)


@query()
def layer_woodland(spark, d):
    return L.opportunity(spark, d, "woodland").select(*X.BOX, "area")


def woodland_sql() -> str:
    """The lattice's cells fall into four triangles by their diagonals, along which triangles and diamonds run; k: south, east, north, west."""
    a, b, c, e = (int(v) // STEP for v in L.AREA)
    inside = f"x >= {a} AND x < {c} AND y >= {b} AND y < {e}"
    quarter = "(VALUES (0, 3, 1), (1, 5, 3), (2, 3, 5), (3, 1, 3)) q(k, cu, cv)"  # centres, in sixths of a cell: near enough to tell sides
    cells = "SELECT shape_kind, ox, oy, s, ox//10 + i AS x, oy//10 + j AS y FROM fx_shape, LATERAL (SELECT unnest(range(CAST(s//10 AS BIGINT))) AS i), LATERAL (SELECT unnest(range(CAST(s//10 AS BIGINT))) AS j) WHERE shape_kind IN (0, 3)"
    u, v = "((x*10 - ox)*6 + 10*cu)", "((y*10 - oy)*6 + 10*cv)"
    held = f"CASE shape_kind WHEN 0 THEN {u} + {v} < 6*s ELSE abs({u} - 3*s) + abs({v} - 3*s) < 3*s END"
    masked = cells_of("SELECT 0 AS g, minx, miny, maxx, maxy FROM cons UNION ALL SELECT 0, minx, miny, maxx, maxy FROM fx_spz WHERE lower(trim(number)) = '3'", STEP)
    name = "(x*1000000 + y)*4"
    return with_recursive(
        fixtures.cte(*LAYER_FX),
        f"{CONS}, mk AS ({masked}), tri AS (SELECT DISTINCT x, y, k, {name} + k AS id FROM ({cells}) f, {quarter} WHERE {held} AND {inside} AND NOT EXISTS (SELECT 1 FROM mk WHERE mk.x = f.x AND mk.y = f.y)), "
        f"nb AS (SELECT id AS p, unnest([{name} + (k+1)%4, {name} + (k+3)%4, CASE k WHEN 0 THEN {name} - 4 + 2 WHEN 1 THEN {name} + 4000000 + 3 WHEN 2 THEN {name} + 4 ELSE {name} - 4000000 + 1 END]) AS q FROM tri), "
        "cc(id, part) USING KEY (id) AS (SELECT id, id FROM tri UNION SELECT was.id, min(now.part) FROM recurring.cc AS was JOIN nb ON nb.p = was.id JOIN cc AS now ON now.id = nb.q WHERE now.part < was.part GROUP BY was.id) "
        "SELECT CAST(min(CASE k WHEN 1 THEN x*10+5 ELSE x*10 END) AS DOUBLE) AS minx, CAST(min(CASE k WHEN 2 THEN y*10+5 ELSE y*10 END) AS DOUBLE) AS miny, CAST(max(CASE k WHEN 3 THEN x*10+5 ELSE x*10+10 END) AS DOUBLE) AS maxx, CAST(max(CASE k WHEN 0 THEN y*10+5 ELSE y*10+10 END) AS DOUBLE) AS maxy, CAST(count(*)*25 AS DOUBLE) AS area FROM tri JOIN cc USING (id) GROUP BY part",
    )


ORACLE_SQL["layer_woodland"] = woodland_sql()


@query()
def layer_peat(spark, d):
    return L.opportunity(spark, d, "peat").select(*X.BOX, F.round("area", 6).alias("area"))


# Buffers as polygons

#: A polygon of 64 corners that a circle holds has this share of the circle's radius squared.
ROUND = "32*sin(pi()/32)"


@query(
    f"SELECT fid, type, CAST(r AS DOUBLE) AS buffer_m, round(2.0*r*(x2-x1+y2-y1) + r*r*{ROUND}, 2) AS area, CAST(x1-r AS DOUBLE) AS minx, CAST(y2+r AS DOUBLE) AS maxy "
    "FROM (SELECT *, CASE type WHEN 'District' THEN 50 WHEN 'Local' THEN 30 WHEN 'National' THEN 150 WHEN 'Regional' THEN 100 END AS r FROM fx_line) WHERE r IS NOT NULL",
    "fx_line",
)
def buffer_polys(spark, d):
    """Waterlines as polygons, by the distance of their type."""
    lines = fx(spark, d, "fx_line").select("fid", "type", G.line(("x1", "y1"), ("x2", "y2")).alias("geom"))
    known, _ = buffer.keyed(lines, "type", L.BUFFERS)
    wide = buffer.buffered(known, "buffer_m")
    return known.drop("geom").join(wide.hint("merge"), "fid").select("fid", "type", "buffer_m", F.round("area", 2).alias("area"), F.round("minx", 6).alias("minx"), F.round("maxy", 6).alias("maxy"))


@query(f", {REPAIRED} SELECT count(*) AS n, count(*) FILTER (WHERE fixed) AS n_invalid FROM rep", "fx_shape")
def validate_layer(spark, d):
    return checks.layer_state(broken(spark, d))


# Tiles that are worked out with what lies around them

WIDE = "SELECT 0 AS g, minx-20 AS minx, miny-20 AS miny, maxx+20 AS maxx, maxy+20 AS maxy FROM fx_flood WHERE risk_band='High'"


@query()
def tile_halo(spark, d):
    """High flood extent widened by 20 m, less runoff attenuation, tile by tile."""
    part = tiles.dealt_to_tiles(L.boxes(spark, d, "fx_flood").filter("risk_band = 'High'"), waterbodies(spark, d), 250.0)
    wide = part.withColumns({c: F.col(c) + (-20 if c.startswith("min") else 20) for c in X.BOX}).withColumn("geom", G.box_polygon())
    return told(tiles.polygons_by_tile(wide, L.boxes(spark, d, "fx_raf"), waterbodies(spark, d)), "tile_id", "status", apart=True)


def waterbodies(spark, d):
    return L.boxes(spark, d, "fx_waterbody").withColumnRenamed("wb_id", "tile_id")


ORACLE_SQL["tile_halo"] = with_recursive(
    fixtures.cte("fx_flood", "fx_raf", "fx_waterbody"),
    f"f AS ({cells_of(WIDE, STEP)}), m AS ({cells_of(RAF, STEP)}), k AS (SELECT w.fid AS g, f.x, f.y FROM (SELECT x, y FROM f ANTI JOIN m USING (x, y)) f JOIN fx_waterbody w ON f.x*10>=w.minx AND f.x*10<w.maxx AND f.y*10>=w.miny AND f.y*10<w.maxy), "
    f"{labelled_sql('SELECT * FROM k')}, {told_sql(STEP)}, pinch AS (SELECT g AS pg, count(*) AS closed FROM pts WHERE m IN (6,9) GROUP BY 1) "
    # Where a part meets itself in a corner it closes one more hole, which Euler's number of cells connected by sides doesn't count.
    "SELECT w.wb_id AS tile_id, CASE WHEN g IS NULL THEN 'empty' ELSE concat('ok:', n_parts::VARCHAR) END AS status, area, n_parts, n_holes + coalesce(closed, 0) AS n_holes, n_vertices, corners FROM fx_waterbody w LEFT JOIN res ON res.g=w.fid LEFT JOIN pinch ON pg=w.fid",
)


@query("SELECT w.wb_id AS tile_id, count(p.fid) AS n, CASE count(p.fid) WHEN 0 THEN 'empty' ELSE concat('ok:', CAST(count(p.fid) AS VARCHAR)) END AS status FROM fx_waterbody w LEFT JOIN fx_point p ON p.x BETWEEN w.minx AND w.maxx AND p.y BETWEEN w.miny AND w.maxy AND p.fid IN (SELECT q.fid FROM fx_point q JOIN fx_spz s ON q.x > s.minx-30 AND q.x < s.maxx+30 AND q.y > s.miny-30 AND q.y < s.maxy+30) GROUP BY 1", "fx_waterbody", "fx_point", "fx_spz")
def tile_halo_points(spark, d):
    """Points within zones widened by 30 m, tile by tile."""
    part = tiles.dealt_to_tiles(L.points(spark, d), waterbodies(spark, d), 250.0)
    wide = L.boxes(spark, d, "fx_spz").withColumns({c: F.col(c) + (-30 if c.startswith("min") else 30) for c in X.BOX}).withColumn("geom", G.box_polygon())
    near = X.anywhere(part, wide, strict=True)
    return tiles.states(tiles.points_by_tile(near, waterbodies(spark, d)).groupBy("tile_id").agg(F.count("*").alias("n")), waterbodies(spark, d))
