import math
import random

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import buffer, checks

SCHEMA = "fid long, type string, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"
CIRCLE = 32 * math.sin(math.pi / 32)  # of 64 corners


def test_lines_at_any_angle_and_bends(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(20):
        x, y, a, n, d = rng.uniform(-900, 900), rng.uniform(-900, 900), rng.uniform(0, 6.3), rng.uniform(1, 300), rng.choice([5, 30])
        rows.append((i, "ab"[d == 30], ("line", [[[(x, y), (x + n * math.cos(a), y + n * math.sin(a))]]])))
        want[i] = 2 * d * n + d * d * CIRCLE
    rows += [(20, "a", ("line", [[[(0.0, 0.0), (100.0, 0.0), (100.0, 100.0)]], [[(50.0, 0.0), (60.0, 0.0)]]])), (21, "c", ("line", [[[(0.0, 0.0), (1.0, 0.0)]]]))]
    known, unknown = buffer.keyed(spark.createDataFrame(rows, SCHEMA), "type", {"a": 5, "b": 30})
    got = {r.fid: r for r in buffer.buffered(known, "buffer_m", cell=130.0).collect()}
    assert [tuple(r) for r in unknown.collect()] == [("c", 1)] and set(got) == set(range(21))
    assert all(abs(got[i].area - want[i]) < 1e-2 and len(got[i].geom.parts) == 1 for i in want)
    true = 2000 - 25 + math.pi * 25 + math.pi * 25 / 4  # two halves at the ends, a quarter outside of the bend; inside it 5 x 5 count once
    assert true * 0.998 < got[20].area <= true + 1e-3


def test_polygons_keep_their_inside(spark):
    square = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)]
    hole = [(40.0, 40.0), (60.0, 40.0), (60.0, 60.0), (40.0, 60.0), (40.0, 40.0)]
    df = spark.createDataFrame([(1, "a", ("polygon", [[square]])), (2, "a", ("polygon", [[square, hole]])), (3, "a", ("polygon", [[square, hole]]))], SCHEMA).withColumn("d", F.when(F.col("fid") < 3, F.col("fid") * 5))
    got = {r.fid: r for r in buffer.buffered(df, "d").collect()}
    assert abs(got[1].area - (10000 + 4 * 100 * 5 + 25 * math.pi)) < 0.2
    assert abs(got[2].area - (10000 + 4 * 100 * 10 + 100 * math.pi)) < 0.8 and len(got[2].geom.parts[0]) == 1  # ten metres fill the hole
    assert got[3].area == 9600


def test_checks(spark):
    good = G.with_bounds(spark.createDataFrame([(1, "a", ("polygon", [[[(0.0, 0.0), (9.0, 0.0), (0.0, 9.0), (0.0, 0.0)]]]))], SCHEMA))
    bad = G.with_bounds(spark.createDataFrame([(2, "a", ("polygon", [[[(0.0, 0.0), (9.0, 9.0), (9.0, 0.0), (0.0, 9.0), (0.0, 0.0)]]]))], SCHEMA))
    assert checks.validated(good, "step", strict=True) is good
    assert checks.validated(bad, "step") is bad
    with pytest.raises(ValueError, match="1 of 2"):
        checks.validated(good.unionByName(bad), "step", strict=True)
    with pytest.raises(checks.EmptyLayerError):
        checks.validated(good.limit(0), "step")


def test_single_segments_skip_the_union(spark, monkeypatch):
    """A capsule by itself is what the union makes of it; only keys with more than one piece are swept."""
    one, two = [(0.0, 0.0), (70.0, 40.0)], [(0.0, 0.0), (50.0, 0.0), (50.0, 80.0)]
    rows = [(1, "a", ("line", [[one]])), (2, "a", ("line", [[two]])), (3, "a", ("line", [[[(5.0, 5.0), (5.0, 5.0)]]])), (4, "a", ("line", [[one]])), (4, "a", ("line", [[one[::-1]]]))]
    df, swept, union = spark.createDataFrame(rows, SCHEMA), [], buffer.O.union

    def kept(pieces, *options):
        swept.extend(r.fid for r in pieces.collect())
        return union(pieces, *options)

    monkeypatch.setattr(buffer.O, "union", kept)
    got = {r.fid: r for r in buffer.buffered(df, 10.0).collect()}
    assert sorted(swept) == [2, 2, 3, 4, 4] and set(got) == {1, 2, 3, 4}
    # The same capsule from either end has to be swept, which gives corners and area alike.
    ring, other = ([(p.x, p.y) for p in got[i].geom.parts[0][0]] for i in (1, 4))
    assert len(ring) == len(other) and all(abs(a - c) < 1e-5 and abs(b - d) < 1e-5 for (a, b), (c, d) in zip(ring, other, strict=True))
    assert abs(got[1].area - got[4].area) < 1e-3 and abs(got[1].minx - got[4].minx) < 1e-5
