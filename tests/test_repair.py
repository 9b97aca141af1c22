import math
import random
from threading import Thread

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import repair
from landweave.operators.storage import written
from landweave.sources import silver

SCHEMA = "fid long, name string, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"


def polygons(spark, *shapes):
    """Shapes are lists of parts, parts lists of rings; rings are closed here unless they end with None."""
    ring = lambda r: [(float(x), float(y)) for x, y in (r[:-1] if r[-1] is None else [*r, r[0]])]
    return G.with_bounds(spark.createDataFrame([(i, f"n{i}", ("polygon", [[ring(r) for r in part] for part in shape])) for i, shape in enumerate(shapes)], SCHEMA))


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


BOW = [(0, 0), (10, 10), (10, 0), (0, 10)]
SHAPES = [
    [[square(0, 0, 10)]],
    [[BOW]],
    [[square(0, 0, 20), square(2, 2, 8), square(6, 6, 8)]],  # holes overlap
    [[square(0, 0, 10)], [square(5, 5, 10), square(7, 7, 2)]],  # parts overlap
    [[[(0, 0), (10, 0), (10, 10), (0, 10), None]]],  # not closed
    [[square(0, 0, 20), square(15, 5, 10)]],  # a hole reaches out
    [[[(0, 0), (10, 0), (0, 0)]]],  # no area
    [[square(100, 100, 9), square(103, 103, 3)]],
]


def test_make_valid(spark):
    df = polygons(spark, *SHAPES)
    assert {r.fid for r in repair.validity(df, "fid").filter("is_valid").collect()} == {0, 7}
    fixed = written(repair.make_valid(df, cell=6.0), "fixed")
    got = {r.fid: r for r in fixed.withColumn("area", G.area(F.col("geom"))).collect()}
    # 3: the hole of the second part lies within the first part, which fills it
    assert {i: (r.area, len(r.geom.parts), r.name) for i, r in got.items()} == {
        0: (100, 1, "n0"), 1: (50, 2, "n1"), 2: (400 - 112, 1, "n2"), 3: (175, 1, "n3"), 4: (100, 1, "n4"), 5: (350, 1, "n5"), 7: (72, 1, "n7"),
    }
    before = {r.fid: r.geom for r in df.collect()}
    assert all(got[i].geom == before[i] for i in (0, 7))
    assert repair.validity(fixed, "fid").filter("NOT is_valid").count() == 0


def star(n, x, y, r, rng):
    out = [r * (0.5 + rng.random()) for _ in range(n)]
    return [(x + a * math.cos(2 * math.pi * i / n), y + a * math.sin(2 * math.pi * i / n)) for i, a in enumerate(out)]


def test_subdivide(spark):
    rng = random.Random(2)
    df = polygons(spark, [[star(200, 0, 0, 1000, rng)]], [[square(0, 0, 50)]], [[star(90, 5000, 300, 40, rng), star(40, 5000, 300, 5, rng)], [square(0, 0, 7)]])
    pieces = repair.subdivide(df, most=64)
    assert pieces.columns == ["fid", "geom", "minx", "miny", "maxx", "maxy"]
    sized = pieces.select("fid", G.num_coords(F.col("geom")).alias("n"), G.area(F.col("geom")).alias("area"))
    whole = {r.fid: r.area for r in df.select("fid", G.area(F.col("geom")).alias("area")).collect()}
    got = {r.fid: r for r in sized.groupBy("fid").agg(F.max("n").alias("n"), F.min("area").alias("least"), F.sum("area").alias("area"), F.count("*").alias("k")).collect()}
    assert all(got[i].n <= 64 and got[i].least > 0 and abs(got[i].area - whole[i]) <= 1e-6 * whole[i] for i in whole), (got, whole)
    assert got[0].k > 200 / 64 and got[1].k == 1 and got[2].k > 2


def test_validate_once(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    with pytest.raises(FileNotFoundError):
        silver.validate_once(spark, bronze, out)
    polygons(spark, *SHAPES).write.parquet(bronze)
    found = []
    runs = [Thread(target=lambda: found.append(silver.validate_once(spark, bronze, out))) for _ in range(2)]
    for r in runs:
        r.start()
    for r in runs:
        r.join()
    assert len(found) == 2 and found[0] == found[1] != bronze
    names = sorted(p.name for p in (tmp_path / "silver").iterdir() if not p.name.endswith(".crc"))
    assert len(names) == 2  # the marker and one copy: who came second dropped its own
    assert silver.validate_once(spark, bronze, out) == found[0] and sorted(p.name for p in (tmp_path / "silver").iterdir() if not p.name.endswith(".crc")) == names
    assert silver.committed(spark, out) == {"path": found[0], "n_rows": 8, "n_fixed": 6}
    clean = spark.read.parquet(found[0])
    assert sorted(r.fid for r in clean.collect()) == [0, 1, 2, 3, 4, 5, 7] and repair.validity(clean, "fid").filter("NOT is_valid").isEmpty()
    assert silver.validate_once(spark, bronze, out, force=True) not in (found[0], bronze)
    good = str(tmp_path / "good")
    polygons(spark, SHAPES[0], SHAPES[7]).write.parquet(good)
    assert silver.validate_once(spark, good, str(tmp_path / "silver2")) == good
