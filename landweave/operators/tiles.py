"""Layers worked out tile by tile, each with what lies around it, and cut to the exact tile.

An overlay by cells has no seams and needs no tiles; they are for runs by parts, whose results are kept by tile. All tiles of a run are one plan: a
feature is copied to each tile that it comes near, and tiles are groups of the same sweep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import overlay as O
from .spatial import BOX, CELL, candidates, touching


def dealt_to_tiles(features: DataFrame, tiles: DataFrame, halo: float, key: str = "fid", cell: float = CELL) -> DataFrame:
    """Features (points or polygons, with boxes) once for each tile (tile_id, box) whose box, widened by ``halo``, theirs meets.

    ``copy`` tells the copies apart: a 64-bit hash of tile and key. Columns of these two names that features have are replaced. What is near no tile is left out. A layer that widens features, or looks at
    others around them, by less than the halo comes out in each tile as it does without tiles.
    """
    wide = tiles.select("tile_id", *((F.col(c) + (-halo if c.startswith("min") else halo)).alias(c) for c in BOX))
    met = candidates(features.drop("tile_id", "copy"), wide, cell).withColumnRenamed("r_tile_id", "tile_id").drop(*(f"r_{c}" for c in BOX))
    return met.withColumn("copy", F.xxhash64("tile_id", key))


def polygons_by_tile(copies: DataFrame, mask: DataFrame, tiles: DataFrame, cell: float = CELL) -> DataFrame:
    """(tile_id, geom, box, area, n, status): the union of each tile's copies less the mask, inside the tile itself; ``n`` parts.

    ``status`` is `ok:n` or, for tiles that have nothing, `empty` (n = 0, all else null).
    """
    numbered = tiles.select("tile_id", F.xxhash64("tile_id").alias("tile_no"), "geom", *BOX)
    rows = copies.select(F.xxhash64("tile_id").alias("tile_no"), "copy", "geom", *BOX)
    left = O.remainder(rows, mask, numbered, key="copy", by="tile_no", cell=cell, same_key=True).withColumn("n", F.size("geom.parts").cast("long"))
    return states(left.join(numbered.select("tile_no", "tile_id"), "tile_no").drop("tile_no"), tiles)


def points_by_tile(copies: DataFrame, tiles: DataFrame, cell: float = CELL) -> DataFrame:
    """Copies of points that are inside their tile or on its edge; one on the edge of two is in both."""
    own = touching(copies.select("copy", F.col("tile_id").alias("of"), *BOX), tiles.select("tile_id", "geom", *BOX), cell).filter("r_tile_id = of")
    return copies.join(own.select("copy"), "copy", "left_semi")


def states(results: DataFrame, tiles: DataFrame) -> DataFrame:
    """Results (tile_id, n, others) of all tiles with their status, `ok:n` or `empty`; those without any have n = 0 and nulls."""
    out = tiles.select("tile_id").distinct().join(results, "tile_id", "left")
    return out.withColumns({"n": F.coalesce("n", F.lit(0).cast("long")), "status": F.when(F.col("n") > 0, F.concat(F.lit("ok:"), F.col("n").cast("string"))).otherwise("empty")})
