import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import overlay as O
from landweave.operators import spatial as X
from landweave.operators.buffer import buffered
from landweave.operators.checks import EmptyLayerError
from landweave.plans import layers as L

DATA = "/root/testdata/sf0.001"


def test_peat_is_widened_sources_less_physical_constraints(spark, monkeypatch):
    """Its area is that of the union of widened sources in the area, less what constraints cover of it (a few sources, as each sweep takes seconds)."""
    some = L.sources(spark, DATA, "peat").filter("fid % 4 = 0")
    monkeypatch.setattr(L, "sources", lambda s, d, name: some)
    wide = buffered(L.sources(spark, DATA, "peat"), 10.0)
    one = lambda df: O.union(df.select(F.lit(0).cast("long").alias("all"), F.monotonically_increasing_id().alias("fid"), "geom", *X.BOX), "all")
    whole = O.overlay(one(wide).withColumnRenamed("all", "fid"), L.area_of_interest(spark), "intersection")
    left = O.overlay(whole, L.masks(spark, DATA, "peat"), "difference").first().area
    got = L.opportunity(spark, DATA, "peat")
    rows = got.select("area", G.area(F.col("geom")).alias("own"), "minx", "maxx").collect()
    assert abs(sum(r.area for r in rows) - left) < 1e-3 and all(abs(r.area - r.own) < 1e-2 for r in rows)
    assert all(r.minx >= L.AREA[0] and r.maxx <= L.AREA[2] for r in rows)


def test_no_sources(spark, monkeypatch):
    monkeypatch.setattr(L, "sources", lambda s, d, name: L.shapes(s, d).limit(0).select("fid", "geom", *X.BOX))
    with pytest.raises(EmptyLayerError):
        L.opportunity(spark, DATA, "riparian")
    with pytest.raises(ValueError, match="no tile"):
        L.aoi_union(L.boxes(spark, DATA, "fx_waterbody"), L.boxes(spark, DATA, "fx_boundary").limit(0))
