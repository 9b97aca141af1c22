import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators.enrich import Join, enriched, report, resolve

BOXES = "fid long, Grade string, minx double, miny double, maxx double, maxy double"


def layer(spark, *rows):
    return spark.createDataFrame(rows, BOXES).withColumn("geom", G.box_polygon())


def points(spark, *rows):
    return spark.createDataFrame(rows, "fid long, grade string, x double, y double")


def fails(name):
    raise FileNotFoundError(name)


def test_columns_are_found_as_the_join_says():
    assert resolve(["geom", "A", "b"], "a") == "A" and resolve(["geom", "Aa"], "a") is None
    assert resolve(["xSENSITy", "sensit"], "sensit", "sensit") == "sensit" and resolve(["geom", "xSENSITy"], "sensit", "sensit") == "xSENSITy"


def test_first_polygon_wins_and_rows_stay(spark):
    side = layer(spark, (2, "second", 0.0, 0.0, 10.0, 10.0), (1, "first", 5.0, 0.0, 20.0, 10.0), (3, None, 100.0, 0.0, 110.0, 10.0))
    at = points(spark, (1, "old", 2.0, 2.0), (2, "old", 7.0, 2.0), (3, "old", 105.0, 5.0), (4, "old", 500.0, 5.0), (5, "old", None, None))
    joins = [Join("a", rename={"GRADE": "grade", "none": "absent"}, report=True)]
    got = enriched(at, joins, lambda name: side)
    assert got.columns == ["fid", "x", "y", "grade", "absent"]
    assert {r.fid: r.grade for r in got.collect()} == {1: "second", 2: "first", 3: None, 4: None, 5: None}
    assert sorted((r.value or "", r.n_value, r.n, r.n_hit, r.no_match) for r in report(got, joins).collect()) == [("", 3, 5, 2, False), ("first", 1, 5, 2, False), ("second", 1, 5, 2, False)]
    assert enriched(at.limit(0), joins, lambda name: side).count() == 0


def test_polygons_go_by_a_point_inside(spark):
    """The L's box has its middle outside of it."""
    ring = [(0.0, 0.0), (30.0, 0.0), (30.0, 4.0), (4.0, 4.0), (4.0, 30.0), (0.0, 30.0), (0.0, 0.0)]
    shape = spark.createDataFrame([(7, ("polygon", [[ring]]))], "fid long, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>")
    side = layer(spark, (1, "middle", 5.0, 5.0, 40.0, 40.0), (2, "arm", 0.0, 0.0, 4.0, 40.0))
    assert enriched(shape, [Join("a", rename={"grade": "g"})], lambda name: side).first().g == "arm"


def test_policies(spark):
    side, at = layer(spark, (1, "x", 0.0, 0.0, 10.0, 10.0)), points(spark, (1, "old", 2.0, 2.0))
    here, far = (layer(spark, (0, None, a, 0.0, a + 10.0, 10.0)) for a in (0.0, 1e5))
    join = lambda on_fail, name="grade": [Join("a", rename={name: "g"}, on_fail=on_fail)]
    one = lambda *a, **k: enriched(at, *a, **k).first().g
    assert one(join("warn"), fails) is None and one(join("warn", "none"), lambda n: side) is None
    with pytest.raises(FileNotFoundError):
        one(join("raise"), fails)
    with pytest.raises(KeyError, match="no column"):
        one(join("raise", "none"), lambda n: side)
    assert one(join("raise"), lambda n: side, area=here) == "x" and one(join("raise"), lambda n: side, area=far, tile=True) is None
    with pytest.raises(ValueError, match="nothing in the area"):
        one(join("raise"), lambda n: side, area=far)
    with pytest.raises(ValueError, match="nothing in the area"):
        one(join("raise"), lambda n: side.limit(0))
    assert one(join("warn"), lambda n: side.limit(0)) is None


def test_invalid_sides_are_repaired(spark):
    bow = [(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]
    side = G.with_bounds(spark.createDataFrame([(1, "bow", ("polygon", [[bow]]))], "fid long, grade string, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"))
    got = enriched(points(spark, (1, "", 2.0, 5.0), (2, "", 5.0, 1.0)), [Join("a", rename={"grade": "g"}, repaired=True)], lambda name: side)
    assert {r.fid: r.g for r in got.select("fid", F.col("g")).collect()} == {1: "bow", 2: None}
