import duckdb
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import overlay as O
from landweave.operators import spatial as X
from landweave.plans import polygons as P

FEATURES = [(1, 0, 0, 50, 40), (2, 100, 0, 150, 40), (3, 200, 0, 280, 40)]
#: Two holes that meet in a corner; a hole that meets a notch so; two holes apart.
MASK = [(1, 10, 10, 20, 20), (2, 20, 20, 30, 30), (3, 100, 10, 110, 20), (4, 110, 20, 120, 30), (5, 210, 10, 220, 20), (6, 240, 10, 250, 20)]


def boxes(spark, rows):
    df = spark.createDataFrame(rows, "fid long, minx long, miny long, maxx long, maxy long")
    return df.withColumns({c: F.col(c).cast("double") for c in X.BOX}).withColumn("geom", G.box_polygon())


def test_holes_that_meet_in_corners_are_told_as_cells_tell_them(spark):
    left = O.overlay(boxes(spark, FEATURES), boxes(spark, MASK), "difference")
    got = {r.fid: tuple(r)[1:] for r in P.told(left, "fid").collect()}
    rows = lambda boxes: " UNION ALL ".join(f"SELECT {f} AS g, {a} AS minx, {b} AS miny, {c} AS maxx, {d} AS maxy" for f, a, b, c, d in boxes)
    sql = f"WITH RECURSIVE f AS ({P.cells_of(rows(FEATURES), 10)}), m AS ({P.cells_of(rows(MASK), 10)}), {P.labelled_sql('SELECT * FROM f ANTI JOIN m USING (x, y)')}, {P.told_sql(10)} SELECT g, {P.SHAPED} FROM res"
    assert got == {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    assert [got[i][2] for i in (1, 2, 3)] == [1, 0, 2]
    assert sorted((r.fid, r.n_holes) for r in P.told(left, "fid", apart=True).collect()) == [(1, 2), (2, 1), (3, 2)]
