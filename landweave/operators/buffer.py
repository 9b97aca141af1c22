"""Buffers as polygons: a capsule around each segment, joined with the polygon itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import overlay as O
from .rings import rounded
from .spatial import BOX, CELL
from .storage import written

#: Segments of a quarter of a circle.
QUARTER = 16


def capsule(e: Column, distance: Column, quarter: int = QUARTER) -> Column:
    """The ring around a segment (x1, y1, x2, y2): half a polygon of ``4 * quarter`` corners around its end, and one around its start."""
    way = F.atan2(e["y2"] - e["y1"], e["x2"] - e["x1"])
    steps = F.sequence(F.lit(0), F.lit(2 * quarter))

    def half(x: Column, y: Column, start: Column) -> Column:
        return F.transform(steps, lambda i: G.vertex(x + distance * F.cos(start + i * (F.pi() / (2 * quarter))), y + distance * F.sin(start + i * (F.pi() / (2 * quarter)))))

    ring = F.concat(half(e["x2"], e["y2"], way - F.pi() / 2), half(e["x1"], e["y1"], way + F.pi() / 2))
    return F.concat(ring, F.slice(ring, 1, 1))


def buffered(shapes: DataFrame, distance: str | float, key: str = "fid", cell: float = CELL) -> DataFrame:
    """(key, geom, box, area): lines or polygons widened by metres or by a column of their own, in the form of polygons.

    Rows of one ``key`` are joined. Corners of ends and bends lie on the true buffer, so areas fall short of it by 0.2 % of a circle at most.
    A distance that is null or not above 0 leaves lines out and polygons as they are. A key that one capsule is all of needs no union.
    """
    d = (F.col(distance) if isinstance(distance, str) else F.lit(distance)).cast("double")
    wide = shapes.select(key, "geom", d.alias("_d")).withColumn("_e", F.explode(G.edges(F.col("geom")))).filter("_d > 0").select(key, "_e", "_d")
    own = shapes.select(key, "geom").filter("geom.kind = 'polygon'")
    none = own.select(key, *(F.lit(None).cast(wide.schema[c].dataType).alias(c) for c in ("_e", "_d")))
    long = (F.col("_e.x1") != F.col("_e.x2")) | (F.col("_e.y1") != F.col("_e.y2"))
    wide = wide.unionByName(none).withColumn("_lone", F.count("*").over(Window.partitionBy(key)) == 1)
    wide = written(wide.filter("_e IS NOT NULL").withColumn("_lone", F.col("_lone") & long), "buffer-segments")
    round_about = wide.filter("NOT _lone").select(key, G.make("polygon", F.array(F.array(capsule(F.col("_e"), F.col("_d"))))).alias("geom"))
    # Numbers tell pieces of one key apart; the same piece has the same number however often it is worked out.
    pieces = G.with_bounds(round_about.unionByName(own)).withColumn("_piece", F.xxhash64("geom"))
    joined = O.union(pieces.dropDuplicates([key, "_piece"]), key, "_piece", cell).select(key, "geom", "area", *BOX)
    return joined.unionByName(_lone(wide.filter("_lone"), key))


def _lone(segments: DataFrame, key: str) -> DataFrame:
    """(key, geom, area, box) of capsules by themselves: rounded and begun as rings of a union are."""
    rows = segments.select(key, capsule(F.col("_e"), F.col("_d")).alias("_r"))
    rows = rows.withColumn("_r", F.transform(F.slice("_r", 1, F.size("_r") - 1), lambda v: G.vertex(rounded(v["x"]), rounded(v["y"]))))
    rows = rows.withColumn("_at", F.array_position("_r", F.array_min("_r")).cast("int"))
    rows = rows.withColumn("_r", F.concat(F.slice("_r", F.col("_at"), F.size("_r")), F.slice("_r", F.lit(1), F.col("_at"))))
    rows = rows.select(key, G.make("polygon", F.array(F.array("_r"))).alias("geom"))
    return G.with_bounds(rows).withColumn("area", G.area(F.col("geom"))).select(key, "geom", "area", *BOX)


def keyed(lines: DataFrame, by: str, metres: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """Lines with ``buffer_m`` by their type, and the types that have none with their rows, whose lines are left out."""
    table = lines.sparkSession.createDataFrame([(k, float(v)) for k, v in metres.items()], f"{by} string, buffer_m double")
    known = lines.join(F.broadcast(table), by)
    return known, lines.join(F.broadcast(table), by, "left_anti").groupBy(by).agg(F.count("*").alias("n"))
