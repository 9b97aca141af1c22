"""Rings of a region that is given as trapezoids.

Sides that two trapezoids share cancel: upright and level ones along their line, slanted ones piece by piece. What is left are half-edges with the
region on their left. At each vertex a half-edge goes on to the next one clockwise from where it came, which goes round one corner of the region;
loops are cut where they meet themselves. Loops that run anticlockwise are shells, the others holes of the least shell around them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import atan2, hypot, pi

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G

#: Parts of a metre that vertices are rounded to, so that edges cut on either side of a crossing end in one vertex.
GRAIN = 1e6
HALF = "grp long, x1 double, y1 double, x2 double, y2 double, e long"

Vertex = tuple[float, float]


def rounded(c: str | Column) -> Column:
    return F.rint((F.col(c) if isinstance(c, str) else c) * GRAIN) / GRAIN


def half_edges(region: DataFrame) -> DataFrame:
    """(grp, x1, y1, x2, y2, e): directed boundary of each group's region, from what ``cells.sweep`` gives of it. ``e``: the line of a slanted one."""
    r = region.select("grp", *(rounded(c).alias(c) for c in ("y", "top", "low", "high", "low2", "high2")), "e", "e2").filter("y < top")
    side = lambda x, x2, e, turn: F.struct(F.col(x).alias("xa"), F.col(x2).alias("xb"), F.col(e).alias("e"), F.lit(turn).alias("d"))
    sides = r.select("grp", "y", "top", F.explode(F.array(side("low", "high", "e", -1), side("low2", "high2", "e2", 1))).alias("s")).select("grp", "y", "top", "s.*")
    slanted = sides.filter("xa <> xb").groupBy("grp", "xa", "y", "xb", "top").agg(F.sum("d").alias("d"), F.min("e").alias("e")).filter("d <> 0")
    up = F.col("d") > 0
    turned = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    slanted = slanted.select("grp", turned("xa", "xb").alias("x1"), turned("y", "top").alias("y1"), turned("xb", "xa").alias("x2"), turned("top", "y").alias("y2"), F.coalesce("e", F.lit(0).cast("long")).alias("e"))
    level = lambda line, a, b, turn: F.struct(F.col(line).alias("line"), F.col(a).alias("a"), F.col(b).alias("b"), F.lit(turn).alias("d"))
    flat = r.select("grp", F.lit("h").alias("axis"), F.explode(F.array(level("y", "low", "low2", 1), level("top", "high", "high2", -1))).alias("s")).select("grp", "axis", "s.*").filter("a <> b")
    # Along an upright side the region is on the right of those that trapezoids begin with.
    upright = sides.filter("xa = xb").select("grp", F.lit("v").alias("axis"), F.col("xa").alias("line"), F.col("y").alias("a"), F.col("top").alias("b"), (-F.col("d")).alias("d"))
    turn = lambda at, d: F.struct(F.col(at).alias("at"), d.alias("d"))
    turns = flat.unionByName(upright).select("grp", "axis", "line", F.explode(F.array(turn("a", F.col("d")), turn("b", -F.col("d")))).alias("t"))
    # Straight sides are also cut where a slanted one ends on them: there the region may be as narrow as a point.
    ends = slanted.select("grp", F.explode(F.array(F.struct("x1", "y1"), F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1")))).alias("v"))
    mark = lambda axis, line, at: F.struct(F.lit(axis).alias("axis"), F.col(line).alias("line"), F.struct(F.col(at).alias("at"), F.lit(0).alias("d")).alias("t"))
    marks = ends.select("grp", F.explode(F.array(mark("h", "v.y1", "v.x1"), mark("v", "v.x1", "v.y1"))).alias("m")).select("grp", "m.*")
    turns = turns.withColumn("marked", F.lit(False)).unionByName(marks.withColumn("marked", F.lit(True)))
    turns = turns.groupBy("grp", "axis", "line", F.col("t.at").alias("at")).agg(F.sum("t.d").alias("d"), F.bool_or("marked").alias("marked")).filter("d <> 0 OR marked")
    along = Window.partitionBy("grp", "axis", "line").orderBy("at")
    run = turns.withColumns({"n": F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)), "to": F.lead("at").over(along)}).filter("n <> 0 AND to IS NOT NULL")
    run = run.withColumns({"p": F.when((F.col("n") > 0) == (F.col("axis") == "h"), F.col("at")).otherwise(F.col("to")), "q": F.when((F.col("n") > 0) == (F.col("axis") == "h"), F.col("to")).otherwise(F.col("at"))})
    end = lambda along_line, axis: F.when(F.col("axis") == axis, F.col(along_line)).otherwise(F.col("line"))
    straight = run.select("grp", end("p", "h").alias("x1"), end("p", "v").alias("y1"), end("q", "h").alias("x2"), end("q", "v").alias("y2"), F.lit(None).cast("long").alias("e"))
    return slanted.unionByName(straight)


def _kind(s: tuple) -> object:
    return "v" if s[0] == s[2] else "h" if s[1] == s[3] else s[4]


def _loops(half: list[tuple]) -> Iterator[list[Vertex]]:
    """Simple loops of half-edges (x1, y1, x2, y2, e); vertices between pieces of one line are left out."""
    outs: dict[Vertex, list[int]] = {}
    for i, s in enumerate(half):
        outs.setdefault(s[:2], []).append(i)
    angle = lambda ax, ay, bx, by: atan2(by - ay, bx - ax)
    used = bytearray(len(half))
    for first in range(len(half)):
        ring, i = [], first
        while not used[i]:
            used[i] = 1
            ring.append(half[i])
            x1, y1, x, y, _ = half[i]
            ways = outs.get((x, y), [])
            if len(ways) > 1:
                back = angle(x, y, x1, y1)
                ways = sorted(ways, key=lambda k: (back - angle(x, y, *half[k][2:4])) % (2 * pi) or 2 * pi)  # noqa: B023
                ways = [k for k in ways if k == first or not used[k]]
            if not ways:
                break
            i = ways[0]
        open_at, path = {}, []
        for s in ring:
            if s[:2] in open_at:
                at = open_at[s[:2]]
                yield from _simple(path[at:])
                for gone in path[at:]:
                    open_at.pop(gone[:2], None)
                del path[at:]
            open_at[s[:2]] = len(path)
            path.append(s)
        yield from _simple(path)


def _simple(loop: list[tuple]) -> Iterator[list[Vertex]]:
    corners = [s[:2] for before, s in zip(loop[-1:] + loop[:-1], loop, strict=True) if _kind(before) != _kind(s)]
    if len(corners) >= 3:
        at = corners.index(min(corners))
        corners = corners[at:] + corners[:at]
        round_about = sum(hypot(bx - ax, by - ay) for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True))
        if abs(_twice_area(corners)) > 4 / GRAIN * round_about:  # else it is what rounding has left between two edges on one line
            yield corners


def _twice_area(loop: list[Vertex]) -> float:
    x0, y0 = loop[0]
    return sum((ax - x0) * (by - y0) - (bx - x0) * (ay - y0) for (ax, ay), (bx, by) in zip(loop, loop[1:], strict=False))


def _holds(loop: list[Vertex], x: float, y: float) -> bool:
    inside = False
    for (ax, ay), (bx, by) in zip(loop, loop[1:] + loop[:1], strict=True):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            inside = not inside
    return inside


def polygons(half: list[tuple]) -> list[list[list[Vertex]]]:
    """Parts (shell, then holes) that the half-edges bound, in the order of their least vertices; rings are closed and begin there."""
    sized = sorted(((_twice_area(loop), loop) for loop in _loops(half)), key=lambda x: (x[0], x[1]))
    shells = [(size, loop, (min(v[0] for v in loop), min(v[1] for v in loop), max(v[0] for v in loop), max(v[1] for v in loop)), []) for size, loop in sized if size > 0]
    for size, loop in sized:
        if size < 0:
            (ax, ay), (bx, by) = loop[0], loop[1]
            x, y = ax + (bx - ax) * 0.4142, ay + (by - ay) * 0.4142  # seldom where another ring touches
            own = next((s for s in shells if s[0] > -size and s[2][0] <= x <= s[2][2] and s[2][1] <= y <= s[2][3] and _holds(s[1], x, y)), None)
            if own:
                own[3].append(loop)
    return sorted([[r + r[:1] for r in (loop, *sorted(holes))] for _, loop, _, holes in shells])


PARTS = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def stitched(half: DataFrame) -> DataFrame:
    """(grp, geom): the polygon of each group's half-edges. A task holds one group's boundary, as large as the geometry that comes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        group, own = None, []

        def close() -> None:
            parts = polygons(own)
            if parts:
                out.append((group, [[[{"x": x, "y": y} for x, y in r] for r in p] for p in parts]))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.int64()), pa.array([p for _, p in out], PARTS)], ["grp", "parts"])

        for batch in batches:
            for g, *s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != group and own:
                    close()
                    own = []
                group = g
                own.append(tuple(s))
            if len(out) > 1000:
                yield batch_of()
                out.clear()
        if own:
            close()
        if out:
            yield batch_of()

    dealt = half.select(F.col("grp").cast("long").alias("grp"), "x1", "y1", "x2", "y2", "e").repartition("grp").sortWithinPartitions("grp", "x1", "y1", "x2", "y2")
    parts = dealt.mapInArrow(run, "grp long, parts array<array<array<struct<x: double, y: double>>>>")
    return parts.select("grp", G.make("polygon", F.col("parts")).alias("geom"))
