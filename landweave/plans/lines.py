"""Registered queries on lines: bent ones of two paths over the stand-in waterlines, and SQL that cuts each segment by each box."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..functions import geometry as G
from ..operators import lines as N
from . import layers as L
from .registry import query


def bent(spark, d):
    """Each waterline goes on by 500 m aslant; a second path runs 700 m to the east, 1 km to the north of its start."""
    line = fixtures.layer(spark, d, "fx_line")
    path = lambda *ends: F.array(F.array(*(G.vertex(F.expr(x), F.expr(y)) for x, y in ends)))
    parts = F.array(path(("x1", "y1"), ("x2", "y2"), ("x2+300", "y2+400")), path(("x1", "y1+1000"), ("x1+700", "y1+1000")))
    return line.select("fid", "type", G.make("line", parts).alias("geom"))


SEGMENTS = (
    "sg AS (SELECT fid, type, path, seg, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay, CAST(bx-ax AS DOUBLE) AS dx, CAST(by_-ay AS DOUBLE) AS dy, sqrt(CAST((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay) AS DOUBLE)) AS size FROM ("
    "SELECT fid, type, 0 AS path, 0 AS seg, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_ FROM fx_line UNION ALL SELECT fid, type, 0, 1, x2, y2, x2+300, y2+400 FROM fx_line UNION ALL SELECT fid, type, 1, 0, x1, y1+1000, x1+700, y1+1000 FROM fx_line))"
)
#: Stretches inside boxes of region 1, merged along a segment, then linked to paths.
CLIPPED = (
    SEGMENTS + ", "
    "bx AS (SELECT s.*, CASE WHEN dx=0 THEN (CASE WHEN ax BETWEEN minx AND maxx THEN 0 ELSE 2 END) ELSE least((minx-ax)/dx, (maxx-ax)/dx) END AS tx1, CASE WHEN dx=0 THEN 1 ELSE greatest((minx-ax)/dx, (maxx-ax)/dx) END AS tx2, "
    "CASE WHEN dy=0 THEN (CASE WHEN ay BETWEEN miny AND maxy THEN 0 ELSE 2 END) ELSE least((miny-ay)/dy, (maxy-ay)/dy) END AS ty1, CASE WHEN dy=0 THEN 1 ELSE greatest((miny-ay)/dy, (maxy-ay)/dy) END AS ty2 FROM sg s, fx_waterbody w WHERE w.region = 1), "
    "sp AS (SELECT *, greatest(0, tx1, ty1) AS a, least(1, tx2, ty2) AS b FROM bx WHERE greatest(0, tx1, ty1) < least(1, tx2, ty2)), "
    "fr AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY fid, path, seg ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-9 THEN 0 ELSE 1 END AS f FROM sp), "
    "rn AS (SELECT *, sum(f) OVER (PARTITION BY fid, path, seg ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM fr), "
    "mg AS (SELECT fid, type, path, seg, ax, ay, dx, dy, size, min(a) AS a, max(b) AS b FROM rn GROUP BY fid, type, path, seg, ax, ay, dx, dy, size, run), "
    "lk AS (SELECT *, CASE WHEN lag(path) OVER w = path AND lag(seg) OVER w = seg - 1 AND lag(b) OVER w >= 1 - 1e-9 AND a <= 1e-9 THEN 0 ELSE 1 END AS fresh FROM mg WINDOW w AS (PARTITION BY fid ORDER BY path, seg, a))"
)


@query(f", {CLIPPED} SELECT fid, type, round(sum(size*(b-a)), 6) AS len, CAST(sum(fresh) AS BIGINT) AS n_paths, CAST(count(*) + sum(fresh) AS BIGINT) AS n_vertices, round(sum(ax+dx*b + CASE fresh WHEN 1 THEN ax+dx*a ELSE 0 END), 3) AS xs, round(sum(ay+dy*b + CASE fresh WHEN 1 THEN ay+dy*a ELSE 0 END), 3) AS ys FROM lk GROUP BY 1, 2", "fx_line", "fx_waterbody")
def clip_lines(spark, d):
    got = N.clip(bent(spark, d), L.boxes(spark, d, "fx_waterbody").filter("region = 1"))
    v = G.vertices(F.col("geom"))
    total = lambda c: F.round(F.aggregate(v, F.lit(0.0), lambda a, p: a + p[c]), 3)
    return got.select("fid", "type", F.round("length", 6).alias("len"), F.size("geom.parts").cast("long").alias("n_paths"), F.size(v).cast("long").alias("n_vertices"), total("x").alias("xs"), total("y").alias("ys"))


@query(
    f", {CLIPPED}, loc AS (SELECT *, size*(b-a) AS part FROM lk WHERE type = 'Local'), pos AS (SELECT *, coalesce(sum(part) OVER (PARTITION BY fid ORDER BY path, seg, a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, sum(part) OVER (PARTITION BY fid ORDER BY path, seg, a ROWS UNBOUNDED PRECEDING) AS e, sum(part) OVER (PARTITION BY fid) AS total FROM loc), "
    "pts AS (SELECT *, unnest(range(CAST(ceil(round(s, 6)/100) AS BIGINT), CAST(ceil(round(e, 6)/100) AS BIGINT))) AS n FROM pos WHERE round(total, 6) >= 100) "
    "SELECT fid, n, round(ax + dx*(a + (100*n - s)/size), 3) AS x, round(ay + dy*(a + (100*n - s)/size), 3) AS y FROM pts",
    "fx_line", "fx_waterbody",
)
def sample_along(spark, d):
    """Points every 100 m along the local waterlines, inside region 1."""
    inside = N.clip(bent(spark, d).filter("type = 'Local'"), L.boxes(spark, d, "fx_waterbody").filter("region = 1"))
    return N.points_along(inside, 100.0).select("fid", "n", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))
