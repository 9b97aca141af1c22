"""Geometry as nested columns and its measures, as expressions.

``geom`` is STRUCT<kind: STRING, parts: ARRAY<ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>>: parts, rings (the first is the shell, others are
holes; lines have one path) and vertices. Layers carry ``minx, miny, maxx, maxy`` beside it, so that bounding boxes reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vertex(x, y) -> Column:
    return F.struct(F.col(x).cast("double").alias("x") if isinstance(x, str) else x.cast("double").alias("x"), F.col(y).cast("double").alias("y") if isinstance(y, str) else y.cast("double").alias("y"))


def make(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))


def box_polygon() -> Column:
    """The polygon of ``minx, miny, maxx, maxy``."""
    ring = F.array(vertex("minx", "miny"), vertex("maxx", "miny"), vertex("maxx", "maxy"), vertex("minx", "maxy"), vertex("minx", "miny"))
    return make("polygon", F.array(F.array(ring)))


def point(x: str = "x", y: str = "y") -> Column:
    return make("point", F.array(F.array(F.array(vertex(F.col(x), F.col(y))))))


def line(*ends: tuple[str, str]) -> Column:
    return make("line", F.array(F.array(F.array(*(vertex(x, y) for x, y in ends)))))


def shape_polygon() -> Column:
    """Triangle, L, square with a hole or diamond of ``shape_kind`` at (ox, oy) with size ``s``."""

    def ring(*points: tuple[float, float]) -> Column:
        closed = [*points, points[0]]
        return F.array(*(vertex(F.col("ox") + F.col("s") * F.lit(a), F.col("oy") + F.col("s") * F.lit(b)) for a, b in closed))

    kinds = [
        [[(0, 0), (1, 0), (0, 1)]],
        [[(0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1)]],
        [[(0, 0), (1, 0), (1, 1), (0, 1)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]],
        [[(0.5, 0), (1, 0.5), (0.5, 1), (0, 0.5)]],
    ]
    out = F.when(F.col("shape_kind") == 0, F.array(*(ring(*r) for r in kinds[0])))
    for k, rings in enumerate(kinds[1:], 1):
        out = out.when(F.col("shape_kind") == k, F.array(*(ring(*r) for r in rings)))
    return make("polygon", F.array(out))


def ring_area(ring: Column) -> Column:
    """Twice the signed area, by the shoelace rule."""
    places = F.sequence(F.lit(1), F.size(ring) - 1)
    return F.aggregate(places, F.lit(0.0), lambda a, i: a + F.get(ring, i - 1)["x"] * F.get(ring, i)["y"] - F.get(ring, i)["x"] * F.get(ring, i - 1)["y"])


def area(geom: Column) -> Column:
    """Planar area; holes are subtracted."""
    part = lambda p: F.abs(ring_area(p[0])) - F.aggregate(F.slice(p, 2, F.size(p)), F.lit(0.0), lambda a, r: a + F.abs(ring_area(r)))
    return F.aggregate(geom["parts"], F.lit(0.0), lambda a, p: a + part(p)) / 2


def is_box(geom: Column) -> Column:
    """Whether a polygon is its own bounding box (``minx`` to ``maxy``): one ring of five vertices at the corners, with the box's area."""
    ring = F.get(F.get(geom["parts"], F.lit(0)), F.lit(0))
    corners = F.forall(ring, lambda v: ((v["x"] == F.col("minx")) | (v["x"] == F.col("maxx"))) & ((v["y"] == F.col("miny")) | (v["y"] == F.col("maxy"))))
    whole = F.abs(ring_area(ring)) == 2 * (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))
    return F.coalesce((F.size(vertices(geom)) == 5) & (F.size(geom["parts"]) == 1) & (F.size(ring) == 5) & corners & whole, F.lit(False))


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom["parts"]))


def num_coords(geom: Column) -> Column:
    return F.size(vertices(geom))


def length(geom: Column) -> Column:
    """Length of all paths."""
    path = lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0.0), lambda a, i: a + F.hypot(F.get(r, i)["x"] - F.get(r, i - 1)["x"], F.get(r, i)["y"] - F.get(r, i - 1)["y"]))
    return F.aggregate(F.flatten(geom["parts"]), F.lit(0.0), lambda a, r: a + path(r))


def edges(geom: Column) -> Column:
    """Segments of all rings."""
    ring = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(F.get(r, i - 1)["x"].alias("x1"), F.get(r, i - 1)["y"].alias("y1"), F.get(r, i)["x"].alias("x2"), F.get(r, i)["y"].alias("y2")))
    return F.flatten(F.transform(F.flatten(geom["parts"]), ring))


def with_bounds(df: DataFrame) -> DataFrame:
    """Adds the bounding box of ``geom``."""
    at = vertices(F.col("geom"))
    pick = lambda f, c: f(F.transform(at, lambda v: v[c]))
    return df.withColumns({"minx": pick(F.array_min, "x"), "miny": pick(F.array_min, "y"), "maxx": pick(F.array_max, "x"), "maxy": pick(F.array_max, "y")})


def explode_parts(df: DataFrame) -> DataFrame:
    """A row for each part of polygons; other kinds are left out."""
    return df.filter("geom.kind = 'polygon'").withColumn("_p", F.explode("geom.parts")).withColumn("geom", make("polygon", F.array("_p"))).drop("_p")


def slug(name: Column) -> Column:
    """Lower case, runs of other characters than letters and digits to one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def covers(e: Column, x: Column, y: Column, right: bool, up: bool) -> Column:
    """Whether the polygon with edges ``e`` covers the points just beside (x, y), to the right or left and above or below it."""

    def crossed(s: Column) -> Column:
        low, high = F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"])
        spans = (low <= y) & (y < high) if up else (low < y) & (y <= high)
        at = s["x1"] + (y - s["y1"]) * F.try_divide(s["x2"] - s["x1"], s["y2"] - s["y1"])
        return spans & ((at <= x) if right else (at < x))

    return (F.size(F.filter(e, crossed)) % 2 == 1).cast("int")


def on_boundary(e: Column, x: Column, y: Column) -> Column:
    return F.exists(e, lambda s: ((s["x2"] - s["x1"]) * (y - s["y1"]) == (s["y2"] - s["y1"]) * (x - s["x1"])) & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"])))


def canonical_ring(ring: Column) -> Column:
    """The vertices of a closed ring once each, anticlockwise, from the least (x, y) on."""
    once = F.slice(ring, 1, F.size(ring) - 1)
    turned = F.when(ring_area(ring) < 0, F.reverse(once)).otherwise(once)
    first = F.array_position(turned, F.array_min(turned)).cast("int")
    return F.concat(F.slice(turned, first, F.size(turned) - first + 1), F.slice(turned, F.lit(1), first - 1))


def geometry_hash(geom: Column) -> Column:
    """SHA-256 of a polygon, the same wherever its rings start, whichever way they run, and however its holes and parts are ordered."""
    ring = lambda r: F.array_join(F.transform(canonical_ring(r), lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))), ",")
    part = lambda p: F.concat_ws(";", ring(p[0]), F.array_join(F.array_sort(F.transform(F.slice(p, 2, F.size(p)), ring)), ";"))
    return F.sha2(F.concat_ws("|", geom["kind"], F.array_join(F.array_sort(F.transform(geom["parts"], part)), "|")), 256)
