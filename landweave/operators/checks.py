"""Assertions on layers at run time."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import overlay as O
from .repair import validity
from .spatial import CELL

LOG = logging.getLogger(__name__)


class EmptyLayerError(ValueError):
    """A step has no features, which a small area may well have: callers can tell it from a fault."""


def layer_state(polygons: DataFrame, key: str = "fid") -> DataFrame:
    """One row: ``n`` features and ``n_invalid`` of them."""
    return validity(polygons, key).agg(F.count("*").alias("n"), F.count_if(~F.col("is_valid")).alias("n_invalid"))


def validated(polygons: DataFrame, step: str, key: str = "fid", strict: bool = False) -> DataFrame:
    """The layer itself, once it is known to have features (else EmptyLayerError) and, if ``strict``, only valid ones (else ValueError).

    Without ``strict`` invalid ones are counted in a warning.
    """
    state = layer_state(polygons, key).first()
    if not state.n:
        raise EmptyLayerError(f"{step}: no features")
    if state.n_invalid:
        if strict:
            raise ValueError(f"{step}: {state.n_invalid} of {state.n} features are not valid")
        LOG.warning("%s: %d of %d features are not valid", step, state.n_invalid, state.n)
    return polygons


class OverlapError(RuntimeError):
    """Tiles share area, in which a merge would count features twice."""


def check_no_overlap(tiles: DataFrame, key: str = "tile_id", tolerance: float = 1.0, cell: float = CELL) -> DataFrame:
    """The tiles themselves, once it is known that pairs of them share no more than ``tolerance`` square metres in all; OverlapError with the five worst else.

    Pairs are looked for only where the sum is too large. Shared sides have no area.
    """
    total = O.doubled_area(tiles, cell)
    if total > tolerance:
        worst = O.overlaps(tiles, key, cell).orderBy(F.desc("area"), "a", "b").limit(5).collect()
        raise OverlapError(f"tiles share {total:,.1f} m2; worst: " + "; ".join(f"{r.a} and {r.b}: {r.area:,.1f} m2" for r in worst))
    return tiles
