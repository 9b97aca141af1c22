from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import overlay as O
from landweave.operators import spatial as X
from landweave.operators import tiles as T
from landweave.operators.buffer import buffered
from landweave.sources import page_cache

BOXES = "fid long, tile_id string, minx double, miny double, maxx double, maxy double"


def boxes(spark, *rows):
    return spark.createDataFrame(rows, BOXES).withColumn("geom", G.box_polygon())


def test_tiled_equals_untiled(spark):
    """Round buffers reach over the seam of two tiles; what a feature in the halo adds is in the tile, what lies outside isn't."""
    tiles = boxes(spark, (1, "a", 0.0, 0.0, 100.0, 100.0), (2, "b", 100.0, 0.0, 200.0, 100.0), (3, "none", 900.0, 900.0, 950.0, 950.0))
    features = boxes(spark, (1, None, 80.0, 40.0, 97.0, 60.0), (2, None, 101.0, 45.0, 130.0, 80.0), (3, None, 10.0, 10.0, 30.0, 30.0), (4, None, 205.0, 10.0, 240.0, 20.0), (5, None, 5000.0, 0.0, 5010.0, 10.0))
    mask = boxes(spark, (1, None, 90.0, 50.0, 110.0, 55.0))
    copies = T.dealt_to_tiles(features, tiles, 20.0)
    assert sorted((r.tile_id, r.fid) for r in copies.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 4)]
    wide = buffered(copies, 10.0, key="copy").join(copies.select("copy", "tile_id"), "copy")
    got = {r.tile_id: r for r in T.polygons_by_tile(wide, mask, tiles, cell=64.0).collect()}
    whole = O.union(buffered(features, 10.0).withColumn("g", F.lit(0)), "g").withColumnRenamed("g", "fid")
    want = {r.tile_id: r.area for r in O.overlay(tiles.select("fid", "tile_id", "geom", *X.BOX), O.overlay(whole, mask, "difference"), "intersection").collect()}
    assert set(want) == {"a", "b"} and all(abs(got[t].area - want[t]) < 1e-6 for t in want)
    assert {t: r.status for t, r in got.items()} == {"a": "ok:2", "b": "ok:2", "none": "empty"}
    assert got["none"].geom is None and got["none"].n == 0
    assert {r.status for r in T.polygons_by_tile(wide.limit(0), mask, tiles).collect()} == {"empty"}


def test_points_by_tile(spark):
    tiles = boxes(spark, (1, "a", 0.0, 0.0, 100.0, 100.0), (2, "b", 100.0, 0.0, 200.0, 100.0))
    points = X.as_points(spark.createDataFrame([(1, 50.0, 50.0), (2, 100.0, 50.0), (3, 110.0, 50.0), (4, 210.0, 50.0)], "fid long, x double, y double"))
    copies = T.dealt_to_tiles(points, tiles, 20.0)
    assert copies.count() == 6  # 2 and 3 are near both, 4 is near b
    assert sorted((r.tile_id, r.fid) for r in T.points_by_tile(copies, tiles).collect()) == [("a", 1), ("a", 2), ("b", 2), ("b", 3)]


ASKED = "layer string, box array<double>, condition string, page_size long, told long"


def test_page_cache(spark):
    box = [0.2, 0.0, 10.0, 10.0]
    rows = [("whole", box, None, 10, 25), ("gap", box, None, 10, 30), ("unknown", box, None, 10, None), ("none", None, None, 10, 0), ("new", box, "a", 10, 5), ("untold", None, None, 10, None)]
    asked = spark.createDataFrame(rows, ASKED)
    ids = {r.layer: r.identity for r in page_cache.identified(asked).collect()}
    pages = [("whole", o) for o in (0, 10, 20, 20)] + [("gap", 0), ("gap", 20), ("unknown", 0), ("unknown", 10), ("unknown", 30)]
    ledger = spark.createDataFrame([(n, ids[n], o) for n, o in pages], "layer string, identity string, offset long")
    state = lambda q: {n: sorted(r.offset for r in page_cache.missing(q, ledger).filter(F.col("layer") == n).collect()) for n in ids}
    assert state(asked) == {"whole": [], "gap": [10], "unknown": [20], "none": [], "new": [0], "untold": [0]}
    assert {r.layer: r.resume_from for r in page_cache.resume(asked, ledger).collect()} == {"whole": None, "gap": 10, "unknown": 20, "none": None, "new": 0, "untold": 0}
    assert page_cache.stale(asked, ledger).count() == 0
    near = asked.withColumn("box", F.transform("box", lambda v: v + 0.1))
    assert page_cache.stale(near, ledger).count() == 0  # boxes are told apart by whole metres
    for column, value in (("condition", F.lit("risk = 1")), ("told", F.lit(26)), ("page_size", F.lit(5)), ("box", F.array(*(F.lit(float(i)) for i in range(4))))):
        other = asked.withColumn(column, value.cast(asked.schema[column].dataType))
        assert page_cache.stale(other.filter("layer = 'whole'"), ledger).count() == 4
        assert 0 in [r.offset for r in page_cache.missing(other.filter("layer = 'whole'"), ledger).collect()]
