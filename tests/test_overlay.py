import random

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import overlay as O
from landweave.operators import spatial as X


def layer(spark, rings):
    rows = [(i, ("polygon", [[[(float(x), float(y)) for x, y in [*r, r[0]]] for r in shape]])) for i, shape in enumerate(rings)]
    schema = "fid long, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"
    return G.with_bounds(spark.createDataFrame(rows, schema))


def shapes(rng, n):
    out = []
    for _ in range(n):
        x, y, s = rng.randrange(0, 900, 10), rng.randrange(0, 900, 10), rng.randrange(40, 200, 20)
        kind = rng.randrange(3)
        square = [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
        out.append([square, [(x + s / 4, y + s / 4), (x + s / 2, y + s / 4), (x + s / 4, y + s / 2)]] if kind == 0 else [[(x, y), (x + s, y + 7), (x + 3, y + s)]] if kind == 1 else [square])
    return out


def areas(df):
    return {r.fid: r.area for r in df.collect()}


def test_overlay_identities_and_cell_size(spark):
    rng = random.Random(1)
    a, b = layer(spark, shapes(rng, 25)), layer(spark, shapes(rng, 25))
    own = {r.fid: r.area for r in a.select("fid", G.area(F.col("geom")).alias("area")).collect()}
    diff, inter = areas(O.overlay(a, b, "difference")), areas(O.overlay(a, b, "intersection"))
    for fid, area in own.items():
        assert abs(diff.get(fid, 0) + inter.get(fid, 0) - area) < 1e-6
    other = areas(O.overlay(a, b, "difference", cell=77.0))
    assert other.keys() == diff.keys() and all(abs(other[k] - diff[k]) < 1e-6 for k in diff)
    assert O.iou(a.limit(0), a.limit(0)).first().iou == 1.0


def held(geom, x, y):
    """By crossings of all rings."""
    n = 0
    for part in geom.parts:
        for ring in part:
            for p, q in zip(ring, ring[1:], strict=False):
                n += (p.y > y) != (q.y > y) and x < p.x + (y - p.y) * (q.x - p.x) / (q.y - p.y)
    return n % 2 == 1


def shoelace(ring):
    return sum(p.x * q.y - q.x * p.y for p, q in zip(ring, ring[1:], strict=False)) / 2


def test_rings(spark):
    """What is left holds the same points, has its area, and shells and holes that run the right way round; whatever the cell."""
    rng = random.Random(4)
    a, b = layer(spark, shapes(rng, 25)), layer(spark, shapes(rng, 40))
    left, right = ({r.fid: r.geom for r in df.collect()} for df in (a, b))
    for cell, kinds in ((64.0, ["difference", "union"]),):
        for kind in kinds:
            for r in O.overlay(a, b, kind, cell=cell).collect():
                assert abs(sum(abs(shoelace(part[0])) - sum(abs(shoelace(h)) for h in part[1:]) for part in r.geom.parts) - r.area) < 1e-3
                assert r.geom == left[r.fid] or all(shoelace(part[0]) > 0 and all(shoelace(h) < 0 for h in part[1:]) for part in r.geom.parts)
                assert all(ring[0] == ring[-1] and len({(p.x, p.y) for p in ring}) == len(ring) - 1 for part in r.geom.parts for ring in part)
                assert (r.minx, r.maxy) == (min(p.x for q in r.geom.parts for p in q[0]), max(p.y for q in r.geom.parts for p in q[0]))
                if kind != "union":
                    for _ in range(60):
                        x, y = rng.uniform(r.minx - 5, r.maxx + 5), rng.uniform(r.miny - 5, r.maxy + 5)
                        masked = any(held(g, x, y) for g in right.values())
                        assert held(r.geom, x, y) == (held(left[r.fid], x, y) and masked == (kind == "intersection"))


def test_corners_and_holes(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    polygons = layer(spark, [[square(0, 0, 10)], [square(10, 10, 10)], [square(30, 0, 9), square(33, 3, 3)], [square(39, 0, 9)], [square(100, 0, 3)], [square(103, 0, 6)]])
    clusters = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2), (4, 4), (5, 4)], "node long, root long")
    got = {(r.root, r.part): (r.area, [len(ring) for ring in r.geom.parts[0]]) for r in O.dissolve(polygons, clusters, cell=7.0).collect()}
    # corner touch: two parts; common side with a hole: one part, no vertex on the way; a lower square beside a higher one: six corners
    assert got == {(0, 0): (100, [5]), (0, 1): (100, [5]), (2, 0): (153, [5, 5]), (4, 0): (45, [7])}
    other = layer(spark, [[square(5, 5, 10)], [square(6, 6, 10)]])
    r = O.iou(polygons.filter("fid < 2"), other, cell=4.0).first()
    assert (r.shared, r.area_left, r.area_right) == (25 + 36, 200, 119) and abs(r.iou - 61 / 258) < 1e-12


def test_pinched(spark):
    """A diamond whose corner touches a side: what is left of the strip falls into two parts."""
    strip = layer(spark, [[[(0, 0), (10, 0), (10, 40), (0, 40)]]])
    diamond = layer(spark, [[[(-10, 20), (0, 10), (10, 20), (0, 30)]]])
    for df, area in ((strip, 300), (layer(spark, [[[(0, 0), (40, 0), (40, 10), (0, 10)]]]), 300)):
        mask = diamond if df is strip else layer(spark, [[[(10, 0), (20, 10), (30, 0), (20, -10)]]])
        r = O.overlay(df, mask, "difference").first()
        assert r.area == area and len(r.geom.parts) == 2 and all(len(p) == 1 and len(p[0]) == 5 for p in r.geom.parts)


def test_large_cluster_runs_in_many_tasks(spark):
    """A ring of 2,000 overlapping boxes: one cluster, one part with one hole."""
    from math import cos, pi, sin

    boxes = spark.createDataFrame([(i, *(round(5000 + 4000 * f(2 * pi * i / 2000)) for f in (cos, sin))) for i in range(2000)], "fid long, x long, y long")
    boxes = boxes.selectExpr("fid", "x - 20d minx", "y - 20d miny", "x + 20d maxx", "y + 20d maxy").withColumn("geom", G.box_polygon())
    r = O.dissolve(boxes, boxes.selectExpr("fid node", "0L root")).collect()
    assert len(r) == 1 and len(r[0].geom.parts[0]) == 2 and len(r[0].geom.parts[0][0]) > 1000
    everywhere = {(x, y) for b in boxes.collect() for x in range(int(b.minx), int(b.maxx)) for y in range(int(b.miny), int(b.maxy))}
    assert r[0].area == len(everywhere)


def test_boundary_rules(spark):
    mask = layer(spark, [[[(0, 0), (10, 0), (10, 10), (0, 10)]], [[(10, 0), (20, 0), (20, 10), (10, 10)]]])
    points = X.as_points(spark.createDataFrame([(1, 5, 5), (2, 10, 5), (3, 0, 5), (4, 10, 0), (5, 30, 5)], "fid long, x int, y int"))
    ids = lambda df: sorted(r.fid for r in df.collect())
    assert ids(X.keep_within(points, mask)) == [1, 2]  # the seam is inside
    assert ids(X.subtract(points, mask)) == [3, 4, 5]
    assert ids(X.clip_points(points, mask)) == [1, 2, 3, 4]
    assert ids(X.keep_within(points, mask.limit(0))) == [] and ids(X.subtract(points, mask.limit(0))) == [1, 2, 3, 4, 5]
    assert {r.fid: r.name for r in X.join_first(points, mask.withColumn("name", F.concat(F.lit("m"), "fid")), ["name"]).collect()} == {1: "m0", 2: "m0", 3: "m0", 4: "m0", 5: None}


def test_rows_in_another_order_each_time(spark):
    """Rows that come from a shuffle have no order of their own: polygons keep their numbers all the same."""
    rng = random.Random(9)
    a, b = layer(spark, shapes(rng, 12)), layer(spark, shapes(rng, 20)).coalesce(1)

    def dealt(batches):
        for batch in batches:
            yield batch.take(random.sample(range(batch.num_rows), batch.num_rows))

    moved = b.mapInArrow(dealt, b.schema)
    with_cell = {"cell": 60.0}
    assert areas(O.overlay(a, moved, "intersection", **with_cell)) == pytest.approx(areas(O.overlay(a, b, "intersection", **with_cell)))
    assert abs(O.doubled_area(moved, **with_cell) - O.doubled_area(b, **with_cell)) < 1e-6
