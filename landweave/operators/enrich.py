"""Attributes of other layers for each feature: joins as data, with what to do where a layer fails.

All joins of a call are one pass over the features (``located``): each gets the columns of the first polygon that holds its point, or its
representative point if it is a polygon. Rows never multiply.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import overlay as O
from . import repair
from .spatial import BOX, CELL, as_points, candidates, join_all

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Join:
    """A layer to join. ``rename``: its columns, in any case, and their names in the result; ``column_match``: the same, but where no column has
    the name, the first that contains it counts. ``on_fail``: `warn` (null columns) or `raise`. ``repaired``: invalid polygons are repaired first.
    ``report``: it takes part in ``report``."""

    dataset: str
    rename: dict[str, str] = field(default_factory=dict)
    column_match: dict[str, str] = field(default_factory=dict)
    on_fail: str = "warn"
    repaired: bool = False
    report: bool = False

    @property
    def columns(self) -> list[str]:
        return [*self.rename.values(), *self.column_match.values()]


def resolve(columns: list[str], name: str, part: str | None = None) -> str | None:
    """The column of that name in any case, else the first that contains ``part``; geometry never."""
    known = [c for c in columns if c != "geom"]
    return next((c for c in known if c.lower() == name.lower()), None) or (next((c for c in known if part.lower() in c.lower()), None) if part else None)


def side(layer: DataFrame, join: Join, order: str = "fid") -> DataFrame:
    """(order, geom, box, columns of the join). A column that the layer doesn't have is null, or KeyError if the join is to raise."""
    pairs = [(out, resolve(layer.columns, name)) for name, out in join.rename.items()] + [(out, resolve(layer.columns, name, name)) for name, out in join.column_match.items()]
    if join.on_fail == "raise" and (missing := [out for out, found in pairs if found is None]):
        raise KeyError(f"{join.dataset}: no column for {missing} (has {layer.columns})")
    columns = [(F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")).alias(out) for out, found in pairs]
    rows = layer.select(order, "geom", *BOX, *columns)
    return repair.make_valid(rows, order) if join.repaired else rows


def _reaches(layer: DataFrame, area: DataFrame | None, cell: float) -> bool:
    """Whether any feature's box meets the area's (any feature at all, if there is no area)."""
    return not (layer if area is None else candidates(layer.select(*BOX), area.select(*BOX), cell)).isEmpty()


def enriched(
    features: DataFrame, joins: list[Join], load: Callable[[str], DataFrame], area: DataFrame | None = None, tile: bool = False, key: str = "fid", order: str = "fid", cell: float = CELL
) -> DataFrame:
    """Features with the columns of all joins, as strings; those that already have such a column lose it.

    ``features``: points (x, y) or polygons (geom, box), with distinct keys. ``load`` gives a layer (order, geom, box, columns) or raises. A layer that fails,
    also by a missing column (but not one whose files break while they are read), stops the run if its join says `raise`, and else gives nulls and a warning. One that must not fail and doesn't reach
    the area stops the run too (ValueError), but for a ``tile``, where no coverage is no fault: nulls and a warning.
    """
    sides, absent = {}, []
    for i, join in enumerate(joins):
        try:
            layer = load(join.dataset)
            if join.on_fail == "raise" and not _reaches(layer, area, cell):
                if not tile:
                    raise ValueError(f"{join.dataset}: nothing in the area")
                LOG.warning("%s: nothing on this tile, %s are null", join.dataset, join.columns)
                absent += join.columns
                continue
            sides[f"_join{i}"] = (side(layer, join, order), join.columns)
        except Exception as fault:  # the policy covers whatever a source may raise
            if join.on_fail == "raise":
                raise
            LOG.warning("%s: %s, %s are null", join.dataset, fault, join.columns)
            absent += join.columns
    wanted = [c for join in joins for c in join.columns]
    plain = features.drop(*wanted)
    if "geom" in features.columns:
        at = as_points(O.representative_points(G.with_bounds(features.select(key, "geom")), key)).select(key, *BOX)
        found = plain.join(join_all(at, sides, key, order, cell).drop(*BOX), key, "left") if sides else plain
    else:
        found = join_all(as_points(plain), sides, key, order, cell) if sides else plain
    return found.select(*plain.columns, *((F.lit(None).cast("string") if c in absent else F.col(c)).alias(c) for c in wanted))


def report(rows: DataFrame, joins: list[Join]) -> DataFrame:
    """(dataset, column, n, n_hit, value, n_value, no_match) of the first column of each join that reports: one row a value, one with null where none was found."""
    told = [j for j in joins if j.report]
    cells = F.explode(F.array(*(F.struct(F.lit(j.dataset).alias("dataset"), F.lit(j.columns[0]).alias("column"), F.col(j.columns[0]).alias("value")) for j in told))).alias("c")
    by = rows.select(cells).groupBy("c.dataset", "c.column", "c.value").agg(F.count("*").alias("n_value"))
    totals = by.groupBy("dataset", "column").agg(F.sum("n_value").alias("n"), F.sum(F.when(F.col("value").isNotNull(), F.col("n_value")).otherwise(0)).alias("n_hit"))
    return totals.join(by, ["dataset", "column"]).select("dataset", "column", "n", "n_hit", "value", "n_value", (F.col("n_hit") == 0).alias("no_match"))
