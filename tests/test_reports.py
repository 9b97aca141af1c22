import datetime
import random

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import checks, joins, ledger
from landweave.operators import overlay as O
from landweave.operators import reports as R
from landweave.operators import spatial as X
from test_overlay import layer, shapes


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def dots(spark, places):
    return X.as_points(spark.createDataFrame([(1000 + i, float(x), float(y)) for i, (x, y) in enumerate(places)], "fid long, x double, y double")).withColumn("geom", G.point()).select("fid", "geom", *X.BOX)


def named(df, name):
    return df.withColumn("layer", F.lit(name))


def test_parity_flags(spark):
    a = layer(spark, [[square(0, 0, 100)], [square(300, 0, 100)]])
    moved = layer(spark, [[square(50, 0, 100)], [square(300, 0, 100)]])
    twice = layer(spark, [[square(0, 0, 100)], [square(0, 0, 100)], [square(300, 0, 100)]])
    own = named(a, "same").unionByName(named(a, "moved")).unionByName(named(a, "twice")).unionByName(named(a, "alone")).unionByName(named(dots(spark, [(1, 1)]), "dots")).unionByName(named(a, None))
    ref = named(a, "same").unionByName(named(moved, "moved")).unionByName(named(twice, "twice")).unionByName(named(a, "only there")).unionByName(named(dots(spark, [(1, 1)]), "dots"))
    got = {r.layer: r for r in R.parity(own, ref).collect()}
    assert sorted(got) == ["alone", "dots", "moved", "same", "twice"]
    assert got["same"].status == "pass" and got["same"].iou == 1.0 and got["same"].area_ha == 2.0
    assert got["moved"].iou == 0.6 and got["moved"].status == "FLAGGED: IoU 0.6 < 0.8"
    assert (got["twice"].iou, got["twice"].area_diff_pct, got["twice"].n_diff_pct) == (1.0, -33.3, -33.3) and got["twice"].status == "FLAGGED: area diff -33.3%"
    assert got["alone"].status == "no_reference" and got["alone"].iou is None and got["alone"].ref_n is None
    assert got["dots"].area_ha is None and got["dots"].iou == 0.0 and got["dots"].status == "FLAGGED: IoU 0.0 < 0.8"
    assert R.parity(own.limit(0), ref).count() == 0 and {r.status for r in R.parity(own, ref.limit(0)).collect()} == {"no_reference"}


def test_overlaps_and_their_check(spark):
    rng = random.Random(5)
    polygons = layer(spark, shapes(rng, 18))
    got = {(r.a, r.b): r.area for r in O.overlaps(polygons).collect()}
    for pair, area in got.items():
        a, b = (polygons.filter(F.col("fid") == i) for i in pair)
        if sum(pair) % 6 == 0:  # each pair by an overlay of its own
            assert abs(O.iou(a, b).first().shared - area) < 1e-6
    assert got and abs(O.doubled_area(polygons) - sum(got.values())) < 1e-6
    assert {(r.a, r.b): round(r.area, 6) for r in O.overlaps(polygons, cell=77.0).collect()} == {k: round(v, 6) for k, v in got.items()}
    with pytest.raises(checks.OverlapError) as said:
        checks.check_no_overlap(polygons, "fid")
    (a, b), _ = max(got.items(), key=lambda x: x[1])
    assert f"worst: {a} and {b}: " in str(said.value) and str(said.value).count(" and ") == min(5, len(got))
    beside = layer(spark, [[square(0, 0, 100)], [square(100, 0, 100)]])
    assert checks.check_no_overlap(beside, "fid") is beside and checks.check_no_overlap(polygons.limit(0), "fid").count() == 0


def test_joins_by_predicate_and_kind(spark):
    frame = [square(0, 0, 100), square(20, 20, 60)]
    zones = layer(spark, [frame, [square(200, 0, 100)], [[(400, 0), (500, 0), (400, 100)]]]).withColumn("name", F.concat(F.lit("z"), "fid"))
    left = layer(spark, [[square(30, 30, 10)], [square(5, 5, 10)], [square(10, 5, 20)], [square(200, 0, 100)], [[(410, 10), (420, 10), (410, 20)]], [square(440, 40, 40)], [square(800, 0, 5)], [square(500, 0, 3)]])
    left = left.unionByName(dots(spark, [(10, 10), (50, 50), (0, 50), (450, 50), (420, 20), (900, 900), (20, 30), (200, 0)]))
    meets = {(1, 0), (2, 0), (3, 1), (4, 2), (5, 2), (7, 2), (1000, 0), (1002, 0), (1003, 2), (1004, 2), (1006, 0), (1007, 1)}
    inside = {(1, 0), (3, 1), (4, 2), (1000, 0), (1004, 2)}
    for predicate, want in (("intersects", meets), ("within", inside)):
        found = joins.pairs(left, zones, predicate)
        assert sorted((r.a, r.b) for r in found.collect()) == sorted(want), predicate
        every, hit = {r.fid for r in left.select("fid").collect()}, {a for a, _ in want}
        rows = {how: joins.spatial_join(left, zones, how, predicate) for how in joins.HOWS}
        assert sorted((r.fid, r.r_name) for r in rows["inner"].collect()) == sorted((a, f"z{b}") for a, b in want)
        assert sorted((r.fid, r.r_name or "") for r in rows["left"].collect()) == sorted([(a, f"z{b}") for a, b in want] + [(a, "") for a in every - hit])
        assert {r.fid for r in rows["semi"].collect()} == hit and {r.fid for r in rows["anti"].collect()} == every - hit and rows["semi"].columns == left.columns
    with pytest.raises(ValueError, match="touches"):
        joins.spatial_join(left, zones, "inner", "touches")
    with pytest.raises(ValueError, match="outer"):
        joins.spatial_join(left, zones, "outer")
    assert joins.spatial_join(left, zones.limit(0), "left").count() == left.count() and joins.spatial_join(left.limit(0), zones).count() == 0


def test_merged_tiles(spark):
    rows = lambda df, tile, name, date: df.withColumns({"tile_id": F.lit(tile), "layer": F.lit(name), "stage": F.lit("opportunity"), "run_date": F.lit(date)})
    old, new = layer(spark, [[square(0, 0, 10)], [square(50, 0, 10)]]), layer(spark, [[square(0, 0, 20)]])
    bow = layer(spark, [[[(0, 0), (10, 10), (10, 0), (0, 10)]]])
    parts = [rows(old, "t1", "pond", "2024-01-01"), rows(new, "t1", "pond", "2024-03-01"), rows(old, "t2", "pond", "2024-01-01"), rows(bow, "t1", "bad", "2024-01-01")]
    parts += [rows(dots(spark, [(5, 5), (7, 7)]), "t2", "dots", "2024-01-01"), rows(dots(spark, [(7, 7)]), "t1", "dots", "2024-01-01"), rows(old.unionByName(dots(spark, [(1, 1), (1, 1)])), "t1", "both", "2024-01-01")]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    whole = R.merged(every)
    report = {r.layer: (r.tiles, r.features, round(r.area_ha, 9), r.valid) for r in R.merge_report(whole).collect()}
    assert report == {"pond": (2, 3, 0.06, True), "bad": (1, 1, 0.0, False), "dots": (2, 2, 0.0, True), "both": (1, 4, 0.0, True)}
    assert sorted((r.tile_id, r.fid) for r in whole.filter("layer = 'dots'").collect()) == [("t1", 1000), ("t2", 1000)] and R.merge_report(R.merged(every.limit(0))).count() == 0


def test_crosscheck_and_progress(spark):
    wrote = spark.createDataFrame([("a", "pond", "opportunity"), ("b", "pond", "opportunity"), ("a", "pond", "prioritised"), ("a", "peat", "opportunity"), ("a", "peat", "supplemented")], "tile_id string, layer string, stage string")
    rows = spark.createDataFrame([("a", "pond", "ok:3"), ("b", "pond", "empty"), ("a", "peat", "ok:1"), ("b", "peat", "ok:1")], "tile_id string, layer string, status string")
    warn = lambda ledger_rows: {(r.layer, r.stage) for r in ledger.crosscheck_stages(wrote, ledger_rows).collect() if r.warn}
    assert warn(rows) == {("peat", "opportunity"), ("peat", "supplemented")} and warn(rows.limit(0)) == set()
    at = lambda m: datetime.datetime(2024, 1, 1, 12, m)
    tiles = spark.createDataFrame([("a", at(0), at(10)), ("b", at(5), at(20)), ("c", at(10), None), ("d", at(35), None), ("e", None, None)], "tile_id string, started timestamp, ended timestamp")
    r = ledger.progress(tiles, at(40), 15.0).first()
    assert (r.total, r.done, r.running, r.minutes, r.rate, r.minutes_left, r.late) == (5, 2, 2, 40.0, 0.05, 60.0, 1)
    assert ledger.progress(tiles.filter("ended IS NULL"), at(40), 15.0).first().minutes_left is None and ledger.progress(tiles.limit(0), at(40), 15.0).first().total == 0


def test_points_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks that compare points get no more of them as layers grow; the result stays."""
    rows = dots(spark, [(i % 40, i % 50) for i in range(400)]).select(F.lit("a").alias("tile_id"), F.lit("p").alias("layer"), F.lit("s").alias("stage"), F.lit("2024-01-01").alias("run_date"), "fid", "geom", *X.BOX)
    sides = rows.filter("fid < 1003").withColumn("layer", F.lit("q")).unionByName(rows)
    want = sorted((r.layer, r.minx, r.miny, r.fid) for r in R.merged(sides).collect())
    monkeypatch.setattr(R, "POINTS_A_TASK", 20)
    got = R.merged(sides)
    assert got.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 8  # of the session's shuffle partitions
    assert sorted((r.layer, r.minx, r.miny, r.fid) for r in got.collect()) == want and len(want) == 203


def test_within_boxes_needs_no_sweep(spark, monkeypatch):
    left = layer(spark, [[square(10, 10, 20)], [[(0, 0), (100, 0), (0, 100)]], [square(90, 90, 20)]])
    right = layer(spark, [[square(0, 0, 100)], [square(5, 5, 30)]])
    monkeypatch.setattr(joins, "_within", lambda *a: pytest.fail("swept"))
    assert sorted(map(tuple, joins.pairs(left, right, "within").collect())) == [(0, 0), (0, 1), (1, 0)]
