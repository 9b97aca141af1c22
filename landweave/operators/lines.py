"""Lines of any number of paths: points at even distances along them, and what of them lies in polygons.

Clipping deals segments and polygons to cells, row by row, so that a long line or a national outline is many small pieces. A piece is cut where it
crosses the polygon's edges in the cell or passes the height of one of their ends; between two cuts it is inside or outside as a whole. What is
inside any polygon is merged along each segment, and segments that stay inside are linked to paths again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cells import PLACE, cut, numbered
from .spatial import BOX, CELL, QUADRANTS
from .storage import written

ENDS = ["x1", "y1", "x2", "y2"]
#: Stretches of a segment that are apart by less than this share of it are one.
SEAM = 1e-9


def segments(lines: DataFrame, key: str = "fid") -> DataFrame:
    """(key, path, seg, x1, y1, x2, y2): segments in their order, of all paths of ``geom`` that have two vertices or more."""
    paths = lines.select(key, F.posexplode(F.flatten("geom.parts")).alias("path", "r")).filter(F.size("r") > 1)
    r = F.col("r")
    steps = F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(F.get(r, i - 1).alias("a"), F.get(r, i).alias("b")))
    rows = paths.select(key, "path", F.posexplode(steps).alias("seg", "s"))
    return rows.select(key, "path", "seg", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))


def points_along(lines: DataFrame, interval: float, key: str = "fid") -> DataFrame:
    """(key, n, x, y): points every ``interval`` along each line, from its start up to, not including, its end; paths follow one another without a gap.

    Lines shorter than the interval, empty and null ones have none. Keys are distinct.
    """
    size = F.sqrt((F.col("x2") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1")))
    along = Window.partitionBy(key).orderBy("path", "seg")
    rows = segments(lines, key).withColumn("size", size)
    before = F.coalesce(F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumns({"start": before, "end": F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.withColumn("total", F.max("end").over(Window.partitionBy(key))).filter(F.col("total") >= interval)
    rows = rows.withColumns({"from": F.ceil(F.col("start") / interval), "to": F.ceil(F.col("end") / interval) - 1}).filter("from <= to")
    at = rows.withColumn("n", F.explode(F.sequence("from", "to")))
    t = F.least(F.greatest((F.col("n") * interval - F.col("start")) / F.col("size"), F.lit(0.0)), F.lit(1.0))
    return at.select(key, "n", (F.col("x1") + (F.col("x2") - F.col("x1")) * t).alias("x"), (F.col("y1") + (F.col("y2") - F.col("y1")) * t).alias("y"))


def _dealt(rows: DataFrame, cell: float) -> DataFrame:
    """Segments with the stretch ``ta`` to ``tb`` (0 to 1) of them that lies in each cell; one that runs on the line between two cells is in both."""
    rows = rows.withColumns({"dx": F.col("x2") - F.col("x1"), "dy": F.col("y2") - F.col("y1")}).withColumns({"ta": F.lit(0.0), "tb": F.lit(1.0)})
    for place, d, start in (("cy", "dy", "y1"), ("cx", "dx", "x1")):
        a, b = F.col(start) + F.col(d) * F.col("ta"), F.col(start) + F.col(d) * F.col("tb")
        rows = rows.withColumn(place, F.explode(F.sequence(F.ceil(F.least(a, b) / cell) - 1, F.floor(F.greatest(a, b) / cell))))
        t = [F.try_divide(F.col(place) * cell + far - F.col(start), d) for far in (0.0, cell)]
        level = F.col(d) == 0
        ta = F.when(level, F.col("ta")).otherwise(F.greatest(F.col("ta"), F.least(*t)))
        rows = rows.withColumns({"ta": ta, "tb": F.when(level, F.col("tb")).otherwise(F.least(F.col("tb"), F.greatest(*t)))}).filter("ta < tb")
    return rows


def _inside(edges: str = "edges"):
    """The stretches (a, b) of a piece that a polygon with these edges covers, its boundary included."""
    e, x1, y1, dx, dy = (F.col(c) for c in (edges, "x1", "y1", "dx", "dy"))
    heights = F.flatten(F.transform(e, lambda s: F.array(F.try_divide(s["y1"] - y1, dy), F.try_divide(s["y2"] - y1, dy))))
    meets = F.transform(e, lambda s: F.try_divide((s["x1"] - x1) * (s["y2"] - s["y1"]) - (s["y1"] - y1) * (s["x2"] - s["x1"]), dx * (s["y2"] - s["y1"]) - dy * (s["x2"] - s["x1"])))
    cuts = F.filter(F.concat(heights, meets), lambda t: (t > F.col("ta")) & (t < F.col("tb")))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("ta", "tb"), cuts)))
    spans = F.zip_with(F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def covered(s):
        x, y = x1 + dx * ((s["a"] + s["b"]) / 2), y1 + dy * ((s["a"] + s["b"]) / 2)
        either = [G.covers(e, x, y, *q) == 1 for q in QUADRANTS]
        return either[0] | either[1] | either[2] | either[3]

    return F.filter(spans, covered)


def _merged(spans: DataFrame, key: str) -> DataFrame:
    """Stretches of each segment that overlap or meet, as one."""
    own = [key, "path", "seg", *ENDS]
    order = Window.partitionBy(key, "path", "seg").orderBy("a", "b")
    far = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("first", F.when(F.col("a") <= far + SEAM, 0).otherwise(1)).withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*own, "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))


def clip(lines: DataFrame, mask: DataFrame, key: str = "fid", cell: float = CELL) -> DataFrame:
    """Lines with the ``geom``, box and ``length`` of what lies in the union of the mask's polygons, its boundary included; other columns stay.

    Lines of which nothing is inside are left out, and so are points in which a line only touches. Seams between polygons don't cut a line. A path
    that leaves and comes back is several. Whether a line that runs along a slanted boundary is inside is up to rounding; along others it is. An
    empty mask, null and empty lines give no rows. Keys are distinct.
    """
    pieces = _dealt(segments(lines, key).filter("x1 <> x2 OR y1 <> y2"), cell)
    polygons = cut(numbered(mask), "poly", cell=cell)
    right = F.least(F.max("maxx"), ((F.col("cx") + 1) * cell).cast("double"))
    sides = polygons.groupBy("poly", *PLACE).agg(
        F.collect_list(F.struct(*ENDS)).alias("edges"), F.min(F.least("x1", "x2")).alias("minx"), F.min("y1").alias("miny"), right.alias("maxx"), F.max("y2").alias("maxy")
    ).drop("poly")
    at = lambda t, start, d: F.col(start) + F.col(d) * F.col(t)
    xs, ys = [at(t, "x1", "dx") for t in ("ta", "tb")], [at(t, "y1", "dy") for t in ("ta", "tb")]
    near = (F.greatest(*xs) >= F.col("minx") - SEAM) & (F.least(*xs) <= F.col("maxx") + SEAM) & (F.greatest(*ys) >= F.col("miny") - SEAM) & (F.least(*ys) <= F.col("maxy") + SEAM)
    met = pieces.join(sides, PLACE).filter(near).select(key, "path", "seg", *ENDS, F.explode(_inside()).alias("s"))
    kept = written(_merged(met.select(key, "path", "seg", *ENDS, "s.a", "s.b"), key), "clipped-lines")
    order = Window.partitionBy(key).orderBy("path", "seg", "a")
    follows = (F.lag("path").over(order) == F.col("path")) & (F.lag("seg").over(order) == F.col("seg") - 1) & (F.lag("b").over(order) >= 1 - SEAM) & (F.col("a") <= SEAM)
    runs = kept.withColumn("new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    end = lambda t: G.vertex(*(F.when(F.col(t) <= SEAM, F.col(f"{c}1")).when(F.col(t) >= 1 - SEAM, F.col(f"{c}2")).otherwise(F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * F.col(t)) for c in "xy"))
    steps = runs.select(key, "run", F.struct("seg", "a", end("a").alias("from"), end("b").alias("to")).alias("s")).groupBy(key, "run").agg(F.array_sort(F.collect_list("s")).alias("s"))
    paths = steps.select(key, F.struct("run", F.concat(F.array(F.get("s", F.lit(0))["from"]), F.transform("s", lambda s: s["to"])).alias("r")).alias("p"))
    whole = paths.groupBy(key).agg(F.array_sort(F.collect_list("p")).alias("p"))
    found = whole.select(key, G.make("line", F.transform("p", lambda p: F.array(p["r"]))).alias("geom"))
    return G.with_bounds(lines.drop("geom", "length", *BOX).join(found, key)).withColumn("length", G.length(F.col("geom")))
