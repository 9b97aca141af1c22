"""Exact polygon overlay: layers are cut to the cells of a grid, cells are swept, and rings are stitched from what is kept.

A group is a feature with the mask polygons near it, a cluster that is merged, or a whole layer. Its cells are swept one by one, so no step sees
a group at once but the last, which holds the boundary of one result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cells import ENDS, PLACE, blocks, cell_boxes, cut, numbered, sweep
from .rings import half_edges, stitched
from .spatial import BOX, CELL, near
from .storage import written

KINDS = {"difference": "a > 0 AND b = 0", "intersection": "a > 0 AND b > 0", "union": "a + b > 0"}


def _side(pieces: DataFrame, group: str, side: str, polygon: str) -> DataFrame:
    return pieces.select(F.col(group).cast("long").alias("grp"), F.lit(side).alias("side"), F.col(polygon).cast("long").alias("poly"), *PLACE, "e", *ENDS)


def regions(edges: DataFrame, keep: str, cell: float = CELL) -> DataFrame:
    """(grp, geom, area) of each group's region where ``keep`` holds; groups that have none are left out."""
    region = written(sweep(edges, cell).filter(keep), "region")
    return stitched(half_edges(region)).join(region.groupBy("grp").agg(F.sum("area").alias("area")), "grp")


def _near(own: DataFrame, key: str, other: DataFrame, cell: float, same_key: bool = False) -> DataFrame:
    """Pieces of ``other`` in the cells where their polygon's box overlaps that of a feature, with its ``key``."""
    a, b = cell_boxes(own, key, cell=cell), cell_boxes(other, "poly", cell=cell)
    b = b.select(*PLACE, "poly", *(F.col(c).alias(f"r_{c}") for c in BOX))
    met = a.join(b, PLACE).filter("maxx > r_minx AND minx < r_maxx AND maxy > r_miny AND miny < r_maxy")
    if same_key:
        met = met.filter(F.col(key) == F.col("poly"))
    return met.select(key, "poly", *PLACE).join(other.drop("maxx"), ["poly", *PLACE])


def _mask(polygons: DataFrame, cell: float, key: str | None = None) -> DataFrame:
    """Polygons cut to cells, told apart by ``key`` or by numbers of their own."""
    rows = polygons.select(F.col(key).cast("long").alias("poly"), "geom", *BOX) if key else numbered(polygons)
    return written(cut(rows, "poly", cell=cell), "mask-pieces")


def with_region(features: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Features with the geometry, box and ``area`` that ``found`` (grp, geom, area) has for them; others are left out."""
    out = features.drop("geom", "area", *BOX).join(found.withColumnRenamed("grp", key), key)
    return G.with_bounds(out)


def overlay(features: DataFrame, mask: DataFrame, kind: str, key: str = "fid", cell: float = CELL, same_key: bool = False, min_area: float = 0.0) -> DataFrame:
    """Features with the ``geom``, box and ``area`` that is left of them; attributes stay, what has none or less than ``min_area`` is dropped.

    ``difference`` and ``intersection`` are with the union of the mask; ``union`` is each feature with whole mask polygons whose box overlaps its own in a cell.
    Features that no mask polygon comes near skip the overlay. ``same_key``: a feature meets only the mask polygon of its own key.
    """
    own, other = written(cut(features.select(key, "geom", *BOX), key, cell=cell), "feature-pieces"), _mask(mask, cell, key if same_key else None)
    if kind == "union":
        return _joined(features, own, other, key, cell, min_area)
    beside = written(_near(own, key, other, cell, same_key), "near-pieces")
    touched = beside.select(key, *(PLACE if kind == "intersection" else [])).distinct()
    edges = _side(own.join(touched, touched.columns, "left_semi"), key, "a", key).unionByName(_side(beside, key, "b", "poly"))
    out = with_region(features, regions(edges, KINDS[kind], cell), key)
    if kind == "difference":
        alone = features.join(beside.select(key).distinct(), key, "left_anti").withColumn("area", G.area(F.col("geom")))
        out = out.unionByName(alone.select(*out.columns))
    return out.filter(F.col("area") >= min_area) if min_area else out


def _joined(features: DataFrame, own: DataFrame, other: DataFrame, key: str, cell: float, min_area: float) -> DataFrame:
    pairs = _near(own, key, other, cell).select(key, "poly").distinct()
    edges = _side(own, key, "a", key).unionByName(_side(other.join(pairs, "poly"), key, "b", "poly"))
    out = with_region(features, regions(edges, KINDS["union"], cell), key)
    return out.filter(F.col("area") >= min_area)


def remainder(features: DataFrame, mask: DataFrame, area_of_interest: DataFrame, key: str = "fid", by: str | None = None, cell: float = CELL, same_key: bool = False) -> DataFrame:
    """(by, geom, box, area) of features minus the mask, inside the union of the area of interest; a layer's first stage.

    Features of one ``by`` (each for itself, if it isn't given) are merged. Cells that the area of interest doesn't reach are not swept.
    ``same_key``: what is merged meets only the area of its own ``by``.
    """
    by = by or key
    own = written(cut(features.select(*dict.fromkeys([by, key]), "geom", *BOX), *dict.fromkeys([by, key]), cell=cell), "feature-pieces")
    out, aoi = _mask(mask, cell), _mask(area_of_interest, cell, by if same_key else None)
    inside = written(_near(own, by, aoi, cell, same_key), "near-pieces")
    cells = inside.select(by, *PLACE).distinct()
    there = own.join(cells, cells.columns, "left_semi")
    edges = [_side(there, by, "a", key), _side(_near(there, by, out, cell), by, "b", "poly"), _side(inside, by, "c", "poly")]
    return G.with_bounds(regions(reduce(DataFrame.unionByName, edges), "a > 0 AND b = 0 AND c > 0", cell).withColumnRenamed("grp", by))


def union(polygons: DataFrame, by: str, key: str = "fid", cell: float = CELL) -> DataFrame:
    """(by, geom, box, area) of the union of each group's polygons, which ``key`` tells apart."""
    pieces = cut(polygons.select(by, key, "geom", *BOX), by, key, cell=cell)
    return G.with_bounds(regions(_side(pieces, by, "a", key), "a > 0", cell).withColumnRenamed("grp", by))


def dissolve(polygons: DataFrame, roots: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """(root, part, geom, box, area): single polygons of the union of each cluster; ``roots``: (node, root) of the polygons' keys.

    A polygon that isn't in ``roots`` is its own cluster. Parts that only meet in a corner stay apart.
    """
    led = polygons.select(key, "geom", *BOX).join(roots.select(F.col("node").alias(key), "root"), key, "left").withColumn("root", F.coalesce("root", key))
    return single(union(led, "root", key, cell), "root")


def single(polygons: DataFrame, *columns: str) -> DataFrame:
    """(columns, part, geom, box, area): a row for each part."""
    parts = polygons.select(*columns, F.posexplode("geom.parts").alias("part", "p")).select(*columns, "part", G.make("polygon", F.array("p")).alias("geom"))
    return G.with_bounds(parts).withColumn("area", G.area(F.col("geom")))


def iou(left: DataFrame, right: DataFrame, cell: float = CELL) -> DataFrame:
    """(iou, shared, area_left, area_right) of the unions of two layers, whose polygons may overlap among themselves; two empty layers agree."""
    sides = [_side(cut(numbered(df.withColumn("all", F.lit(0)), "all"), "all", "poly", cell=cell), "all", s, "poly") for df, s in ((left, "a"), (right, "b"))]
    total = lambda where: F.coalesce(F.sum(F.when(F.expr(where), F.col("area"))), F.lit(0.0))
    sums = sweep(sides[0].unionByName(sides[1]), cell).agg(total("a > 0 AND b > 0").alias("shared"), total("a > 0").alias("area_left"), total("b > 0").alias("area_right"), total("a + b > 0").alias("either"))
    return sums.select(F.when(F.col("either") == 0, 1.0).otherwise(F.col("shared") / F.col("either")).alias("iou"), "shared", "area_left", "area_right")


def iou_by(left: DataFrame, right: DataFrame, by: str, cell: float = CELL) -> DataFrame:
    """(by, iou, shared, area_left, area_right) for each ``by`` that either layer has, as ``iou`` has them for whole layers; 0 where there is no area."""
    group = F.xxhash64(by)
    sides = [_side(cut(numbered(df.withColumn("_g", group), "_g"), "_g", "poly", cell=cell), "_g", s, "poly") for df, s in ((left, "a"), (right, "b"))]
    total = lambda where: F.coalesce(F.sum(F.when(F.expr(where), F.col("area"))), F.lit(0.0))
    sums = sweep(sides[0].unionByName(sides[1]), cell).groupBy("grp").agg(total("a > 0 AND b > 0").alias("shared"), total("a > 0").alias("area_left"), total("b > 0").alias("area_right"), total("a + b > 0").alias("either"))
    names = left.select(by).unionByName(right.select(by)).distinct().withColumn("grp", F.xxhash64(by))
    iou = F.when(F.col("either") > 0, F.col("shared") / F.col("either")).otherwise(0.0).alias("iou")
    return names.join(sums, "grp", "left").select(by, iou, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("shared", "area_left", "area_right")))


def overlaps(polygons: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """(a, b, area), a < b: pairs of a layer's polygons that share some area.

    Polygons that fall into few boxes are compared by these, in pairs that are written nowhere. Of others only pieces of two that are near in a cell are
    swept, a pair in a cell at a time. Keys are distinct.
    """
    sides = blocks(polygons, key, cell)
    told = near(sides.filter("blocks IS NOT NULL").drop("square"), sides.filter("blocks IS NOT NULL").drop("square"), cell).filter(f"{key} < r_{key}")
    across = lambda x, y, axis: F.greatest(F.lit(0.0), F.least(x[f"max{axis}"], y[f"max{axis}"]) - F.greatest(x[f"min{axis}"], y[f"min{axis}"]))
    shared = lambda x, y: across(x, y, "x") * across(x, y, "y")
    both = F.aggregate("blocks", F.lit(0.0), lambda n, x: F.aggregate("r_blocks", n, lambda m, y: m + shared(x, y)))
    told = told.select(F.col(key).alias("a"), F.col(f"r_{key}").alias("b"), both.alias("area")).filter("area > 0")
    rest = written(sides.filter("blocks IS NULL").select(key), "overlap-rest")
    if rest.isEmpty():
        return told
    pieces = written(cut(polygons.select(key, "geom", *BOX), key, cell=cell), "overlap-pieces")
    boxes = cell_boxes(pieces, key, cell=cell)
    met = boxes.join(boxes.select(F.col(key).alias("b"), *PLACE, *(F.col(c).alias(f"r_{c}") for c in BOX)).join(rest.select(F.col(key).alias("b")), "b"), PLACE)
    met = met.filter(f"{key} <> b AND maxx > r_minx AND minx < r_maxx AND maxy > r_miny AND miny < r_maxy").select(F.least(key, "b").alias("a"), F.greatest(key, "b").alias("b"), *PLACE).distinct()
    met = written(met.select("a", "b", F.xxhash64("a", "b").alias("grp"), *PLACE), "overlap-pairs")
    side = lambda of: _side(pieces.withColumnRenamed(key, of).join(met.select("grp", of, *PLACE), [of, *PLACE]), "grp", of, of)
    areas = sweep(side("a").unionByName(side("b")), cell).filter("a > 0 AND b > 0").groupBy("grp").agg(F.sum("area").alias("area")).filter("area > 0")
    return told.unionByName(met.select("grp", "a", "b").distinct().join(areas, "grp").select("a", "b", "area"))


def doubled_area(polygons: DataFrame, cell: float = CELL) -> float:
    """Summed area that pairs of a layer's polygons share: one sweep of the layer, whatever number of pairs."""
    pieces = cut(numbered(polygons.withColumn("all", F.lit(0)), "all"), "all", "poly", cell=cell)
    return sweep(_side(pieces, "all", "a", "poly"), cell).agg(F.coalesce(F.sum(F.col("area") * F.col("a") * (F.col("a") - 1) / 2), F.lit(0.0)).alias("area")).first().area


def representative_points(polygons: DataFrame, key: str) -> DataFrame:
    """(key, x, y): the middle of the widest inner stretch of a scan line half way between the vertices around the box's middle."""
    rows = polygons.select(key, F.posexplode(G.edges(F.col("geom"))).alias("n", "e"), ((F.col("miny") + F.col("maxy")) / 2).alias("half")).select(key, "half", "e.*")
    ys = rows.groupBy(key, "half").agg(F.max(F.when(F.col("y1") <= F.col("half"), F.col("y1"))).alias("lo"), F.min(F.when(F.col("y1") > F.col("half"), F.col("y1"))).alias("hi"))
    at = rows.join(ys.select(key, ((F.col("lo") + F.col("hi")) / 2).alias("y")), key)
    hits = at.filter("least(y1, y2) <= y AND y < greatest(y1, y2)").select(key, "y", (F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"))
    order = Window.partitionBy(key).orderBy("x")
    spans = hits.withColumns({"n": F.row_number().over(order), "x2": F.lead("x").over(order)}).filter("n % 2 = 1")
    return spans.groupBy(key).agg(F.max_by(F.struct(((F.col("x") + F.col("x2")) / 2).alias("x"), "y"), F.struct(F.col("x2") - F.col("x"), -F.col("x"))).alias("p")).select(key, "p.x", "p.y")
