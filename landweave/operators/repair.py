"""Validity of polygons, repair of those that aren't valid, and division of those with many vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import overlay as O
from .cells import cut
from .spatial import BOX, CELL, dealt
from .storage import written

#: Vertices of a piece, as masks are divided into before they meet many features.
MOST_VERTICES, MOST_ROUNDS = 256, 64


def validity(polygons: DataFrame, key: str, cell: float = CELL) -> DataFrame:
    """Polygons with ``is_valid``: rings of four points or more, closed, with some area, and no two of their edges cross
    properly.

    Edges of one polygon meet in the cells of a grid, so a long outline isn't compared with all of itself. A null geometry is not valid.
    """
    flat = polygons.select(key, F.posexplode(G.edges(F.col("geom"))).alias("n", "e")).select(key, "n", "e.*")
    flat = flat.withColumns({"minx": F.least("x1", "x2"), "miny": F.least("y1", "y2"), "maxx": F.greatest("x1", "x2"), "maxy": F.greatest("y1", "y2")})
    flat = written(dealt(flat, cell), "validity-edges")
    turn = lambda ax, ay, bx, by, cx, cy: f"sign(({bx}-{ax})*({cy}-{ay})-({by}-{ay})*({cx}-{ax}))"
    ends = [turn("l.x1", "l.y1", "l.x2", "l.y2", *p) for p in (("r.x1", "r.y1"), ("r.x2", "r.y2"))] + [turn("r.x1", "r.y1", "r.x2", "r.y2", *p) for p in (("l.x1", "l.y1"), ("l.x2", "l.y2"))]
    met = F.expr(f"l.{key} <=> r.{key} AND l.cx = r.cx AND l.cy = r.cy AND l.n < r.n AND l.minx <= r.maxx AND r.minx <= l.maxx AND l.miny <= r.maxy AND r.miny <= l.maxy")
    crossed = flat.alias("l").join(flat.alias("r"), met).filter(f"{ends[0]} * {ends[1]} < 0 AND {ends[2]} * {ends[3]} < 0")
    bad = crossed.select(F.col(f"l.{key}").alias("_bad")).distinct()
    closed = F.forall(F.flatten(F.col("geom.parts")), lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)) & (G.ring_area(r) != 0))
    out = polygons.join(bad.withColumn("_crossed", F.lit(True)), F.col(key).eqNullSafe(F.col("_bad")), "left")
    return out.withColumn("is_valid", F.col("_crossed").isNull() & F.coalesce(closed, F.lit(False))).drop("_bad", "_crossed")


def _closed(ring: Column) -> Column:
    return F.when(F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def repaired(polygons: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """Polygons rebuilt by structure: what shells enclose, less what their holes enclose, joined over parts. Other columns stay.

    Rings are closed if they weren't; a ring that crosses itself encloses what is inside by even-odd. Those that enclose nothing are left out.
    """
    rings = polygons.select(key, F.posexplode("geom.parts").alias("part", "rings")).withColumn("grp", F.xxhash64(key, "part"))
    rings = rings.select(key, "grp", F.posexplode("rings").alias("ring", "path")).select(key, "grp", "ring", G.make("polygon", F.array(F.array(_closed(F.col("path"))))).alias("geom"))
    pieces = written(cut(G.with_bounds(rings), "grp", "ring", cell=cell), "repair-pieces")
    edges = O._side(pieces.filter("ring = 0"), "grp", "a", "ring").unionByName(O._side(pieces.filter("ring > 0"), "grp", "b", "ring"))
    parts = O.regions(edges, "a > 0 AND b = 0", cell).join(rings.select(key, "grp").distinct(), "grp").select(key, F.col("grp").alias("part"), "geom")
    whole = O.union(G.with_bounds(written(parts, "repair-parts")), key, "part", cell)
    return polygons.drop("geom", *BOX).join(whole.drop("area"), key).select(*polygons.columns)


def make_valid(polygons: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """Polygons of which those that aren't valid are ``repaired``; valid ones are untouched. ``key`` tells rows apart."""
    marked = validity(polygons, key, cell)
    bad = written(marked.filter("NOT is_valid").select(key), "invalid-keys")
    return polygons.join(bad, key, "left_anti").unionByName(repaired(polygons.join(bad, key, "left_semi"), key, cell))


def subdivide(polygons: DataFrame, key: str = "fid", most: int = MOST_VERTICES, cell: float = CELL, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(key, geom, box) of single polygons that together are each polygon and have at most ``most`` vertices, closing ones included.

    Those with more are halved at the middle of their box, across its longer side (height if equal), round after round; only they are swept
    again. Pieces without area are left out. What still has more after ``most_rounds`` is left as it is.
    """
    parts = G.explode_parts(polygons.select(key, "geom"))
    now, out = written(G.with_bounds(parts), "subdivide"), []
    for _ in range(most_rounds):
        large = written(now.filter(G.num_coords(F.col("geom")) > most).withColumn("_id", 2 * F.monotonically_increasing_id()), "subdivide-large")
        if large.isEmpty():
            break
        out.append(now.filter(G.num_coords(F.col("geom")) <= most))
        tall = (F.col("maxy") - F.col("miny")) >= (F.col("maxx") - F.col("minx"))
        x, y = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
        both = large.withColumn("_half", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_id", F.col("_id") + F.col("_half"))
        lower, upper = F.col("_half") == 0, F.col("_half") == 1
        halves = both.select("_id", F.when(~tall & upper, x).otherwise(F.col("minx")).alias("minx"), F.when(tall & upper, y).otherwise(F.col("miny")).alias("miny"), F.when(~tall & lower, x).otherwise(F.col("maxx")).alias("maxx"), F.when(tall & lower, y).otherwise(F.col("maxy")).alias("maxy"))
        cuts = O.overlay(both.select(key, "_id", "geom", *BOX), halves.withColumn("geom", G.box_polygon()), "intersection", key="_id", cell=cell, same_key=True)
        now = written(G.with_bounds(G.explode_parts(cuts.select(key, "geom"))), "subdivide")
    for done in out:
        now = now.unionByName(done)
    return now
