import math
import random

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import lines as N

SCHEMA = "fid long, name string, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(p, x, y):
    """Whether a polygon (rings) holds a point, by counting what a ray crosses."""
    odd = False
    for ring in p:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) < x:
                odd = not odd
    return odd


def ring(*points):
    return [*points, points[0]]


def star(rng, x, y, r):
    n = rng.randint(3, 9)
    return ring(*((x + r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * i / n), y + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)))


def cuts(a, b, polygons):
    """Inside stretches of a segment, merged, by cutting it at each crossing with an edge."""
    ts = {0.0, 1.0}
    for p in polygons:
        for r in p:
            for (ax, ay), (bx, by) in zip(r, r[1:], strict=False):
                d = (b[0] - a[0]) * (by - ay) - (b[1] - a[1]) * (bx - ax)
                if d:
                    t = ((ax - a[0]) * (by - ay) - (ay - a[1]) * (bx - ax)) / d
                    ts |= {t} if 0 < t < 1 else set()
    ts, out = sorted(ts), []
    for s, e in zip(ts, ts[1:], strict=False):
        x, y = (a[i] + (b[i] - a[i]) * (s + e) / 2 for i in (0, 1))
        if any(held(p, x, y) for p in polygons):
            if out and s - out[-1][1] < 1e-9:
                out[-1][1] = e
            else:
                out.append([s, e])
    return out


@pytest.mark.parametrize("cell", [70.0, 500.0])
def test_clip_equals_brute_force(spark, cell):
    """Stars, some with holes and overlapping; bent lines of two paths at any angle."""
    rng = random.Random(5)
    polygons = []
    for _ in range(25):
        x, y = rng.uniform(-300, 300), rng.uniform(-300, 300)
        outer = star(rng, x, y, rng.uniform(30, 160))
        polygons.append([outer] + ([ring((x - 3, y - 3), (x + 4, y - 3), (x + 1, y + 5))] if held([outer], x, y) and all(math.hypot(px - x, py - y) > 20 for px, py in outer) else []))
    mask = G.with_bounds(frame(spark, [(i, None, ("polygon", [p])) for i, p in enumerate(polygons)]))
    lines = [(i, f"l{i}", ("line", [[[(rng.uniform(-400, 400), rng.uniform(-400, 400)) for _ in range(rng.randint(2, 5))]] for _ in range(2)])) for i in range(30)]
    got = {r.fid: r for r in N.clip(frame(spark, lines), mask, cell=cell).collect()}
    for i, name, (_, parts) in lines:
        length, paths = 0.0, 0
        for (path,) in parts:
            open_end = False
            for a, b in zip(path, path[1:], strict=False):
                found = cuts(a, b, polygons)
                length += math.dist(a, b) * sum(e - s for s, e in found)
                paths += len(found) - (open_end and bool(found) and found[0][0] == 0)
                open_end = bool(found) and found[-1][1] == 1
        if length == 0:
            assert i not in got
            continue
        r = got[i]
        assert r.name == name and abs(r.length - length) < 1e-6 and len(r.geom.parts) == paths
        assert r.minx == min(v.x for p in r.geom.parts for v in p[0])


def test_clip_along_boundaries_seams_and_corners(spark):
    """Boxes on cell lines: seams don't cut, boundaries count as inside, touching in a point doesn't."""
    box = lambda a, b, c, d: ("polygon", [[ring((a, b), (c, b), (c, d), (a, d))]])
    mask = G.with_bounds(frame(spark, [(1, None, box(0.0, 0.0, 500.0, 500.0)), (2, None, box(500.0, 0.0, 1000.0, 500.0)), (3, None, box(500.0, 0.0, 1000.0, 500.0))]))
    line = lambda *points: ("line", [[list(points)]])
    rows = [
        (1, "through both", line((-100.0, 250.0), (1100.0, 250.0))), (2, "on the seam", line((500.0, -100.0), (500.0, 600.0))), (3, "on top", line((-50.0, 500.0), (1050.0, 500.0))),
        (4, "on the right", line((1000.0, 400.0), (1000.0, 900.0))), (5, "at a corner", line((-100.0, 600.0), (100.0, 400.0))), (6, "only a corner", line((-100.0, 400.0), (100.0, 600.0))),
        (7, "out and in", line((100.0, 100.0), (100.0, -50.0), (200.0, -50.0), (200.0, 100.0))), (8, "away", line((5000.0, 0.0), (6000.0, 0.0))),
        (9, "no move", line((10.0, 10.0), (10.0, 10.0))), (10, None, None), (11, "one vertex", line((1.0, 1.0))), (12, "none", ("line", [])),
    ]
    got = {r.fid: (r.length, len(r.geom.parts)) for r in N.clip(frame(spark, rows), mask).collect()}
    assert got.pop(5) == (pytest.approx(100 * math.sqrt(2)), 1)
    assert got == {1: (1000.0, 1), 2: (500.0, 1), 3: (1000.0, 1), 4: (100.0, 1), 7: (200.0, 2)}
    assert N.clip(frame(spark, rows), mask.limit(0)).count() == 0


def test_points_along(spark):
    bent = ("line", [[[(0.0, 0.0), (30.0, 40.0), (30.0, 140.0)]], [[(500.0, 0.0), (500.0, 0.0), (620.0, 0.0)]]])  # 50 + 100, then 120
    rows = [(1, None, bent), (2, None, ("line", [[[(0.0, 0.0), (99.0, 0.0)]]])), (3, None, ("line", [[[(0.0, 0.0), (200.0, 0.0)]]])), (4, None, None), (5, None, ("line", []))]
    got = sorted(tuple(r) for r in N.points_along(frame(spark, rows), 100.0).collect())
    assert got == [(1, 0, 0.0, 0.0), (1, 1, 30.0, 90.0), (1, 2, 550.0, 0.0), (3, 0, 0.0, 0.0), (3, 1, 100.0, 0.0)]
    assert N.points_along(frame(spark, rows).filter(F.col("fid") == 2), 100.0).count() == 0
