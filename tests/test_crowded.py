import random

from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import cells as C
from landweave.operators import overlay as O


def scattered(spark, rng, n, least, most):
    """Triangles and boxes in two cells; one in ten reaches across."""
    rows = []
    for i in range(n):
        x, y, s = rng.uniform(20, 900), rng.uniform(20, 400), rng.uniform(least, most) * (8 if i % 10 == 0 else 1)
        ring = [(x, y), (x + s, y + s / 3), (x + s / 4, y + s)] if i % 3 else [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
        rows.append((i, ("polygon", [[[*ring, ring[0]]]])))
    return G.with_bounds(spark.createDataFrame(rows, "fid long, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"))


def told(df):
    rings = F.transform(F.flatten("geom.parts"), lambda r: F.array_join(F.array_sort(F.transform(r, lambda v: F.concat_ws(" ", F.round(v["x"], 4), F.round(v["y"], 4)))), ","))
    return {r[0]: (round(r.area, 5), sorted(r.rings)) for r in df.select(df.columns[0], "area", rings.alias("rings")).collect()}


def test_divided_cells_give_the_same_rings(spark, monkeypatch):
    rng = random.Random(7)
    a, b = scattered(spark, rng, 40, 10, 40), scattered(spark, rng, 40, 10, 40)
    whole = a.withColumn("all", F.lit(1).cast("long"))
    want = [told(O.union(whole, "all")), told(O.overlay(a, b, "difference"))]
    monkeypatch.setattr(C, "MOST_SWEPT", 4)
    monkeypatch.setattr(C, "MOST_WORK", 4)
    assert [told(O.union(whole, "all")), told(O.overlay(a, b, "difference"))] == want


def test_crowded_cells_are_divided(spark):
    """Trapezoids grow with the edges, not with edges times heights of the whole cell."""
    polygons = scattered(spark, random.Random(8), 2500, 4, 9).withColumn("all", F.lit(1).cast("long"))
    pieces = O._side(C.cut(polygons, "all", "fid"), "all", "a", "fid")
    assert C.sweep(pieces).count() < 60 * pieces.count()
