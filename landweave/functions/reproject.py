"""Reprojection between WGS 84 degrees and the national grid, as column expressions.

The published method: geodetic to cartesian coordinates, a seven-parameter Helmert shift, and the transverse Mercator projection on the Airy
ellipsoid. It is good to about 5 m; a grid-shift file would be needed for better.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ellipsoids, the projection and the shift from WGS 84 to OSGB36 (metres, parts per million, seconds of arc).
WGS84, AIRY = (6378137.0, 6356752.314245), (6377563.396, 6356256.909)
SCALE, LAT0, LON0, EAST0, NORTH0 = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
SHIFT = {"tx": -446.448, "ty": 125.157, "tz": -542.060, "s": 20.4894, "rx": -0.1502, "ry": -0.2470, "rz": -0.8421}
KNOWN = {4326, 27700}


def num(x: float) -> str:
    """A literal that both dialects read as a double."""
    return repr(x) if "e" in repr(x) else f"{x!r}e0"


def shift_steps(lat: str, lon: str) -> list[tuple[str, str]]:
    """Steps (name, SQL over earlier names) from WGS 84 degrees to ``phi`` and ``lam``, radians on the Airy ellipsoid."""
    a, b = WGS84
    e2 = 1 - b * b / (a * a)
    a2, b2 = AIRY
    f2 = 1 - b2 * b2 / (a2 * a2)
    s = SHIFT["s"] / 1e6
    turn = {k: f"radians({num(SHIFT[k])} / 3600e0)" for k in ("rx", "ry", "rz")}
    steps = [
        ("p0", f"radians({lat})"), ("l0", f"radians({lon})"), ("nu0", f"{num(a)} / sqrt(1e0 - {num(e2)} * sin(p0) * sin(p0))"),
        ("x0", "nu0 * cos(p0) * cos(l0)"), ("y0", "nu0 * cos(p0) * sin(l0)"), ("z0", f"nu0 * {num(1 - e2)} * sin(p0)"),
        ("x1", f"{num(SHIFT['tx'])} + x0 * {num(1 + s)} - y0 * {turn['rz']} + z0 * {turn['ry']}"),
        ("y1", f"{num(SHIFT['ty'])} + x0 * {turn['rz']} + y0 * {num(1 + s)} - z0 * {turn['rx']}"),
        ("z1", f"{num(SHIFT['tz'])} - x0 * {turn['ry']} + y0 * {turn['rx']} + z0 * {num(1 + s)}"),
        ("flat", "sqrt(x1 * x1 + y1 * y1)"), ("f0", f"atan2(z1, flat * {num(1 - f2)})"),
    ]
    for k in range(4):
        steps.append((f"f{k + 1}", f"atan2(z1 + {num(f2)} * {num(a2)} / sqrt(1e0 - {num(f2)} * sin(f{k}) * sin(f{k})) * sin(f{k}), flat)"))
    return [*steps, ("phi", "f4"), ("lam", "atan2(y1, x1)")]


def grid_steps() -> list[tuple[str, str]]:
    """Steps from ``phi`` and ``lam`` on the Airy ellipsoid to ``east`` and ``north``."""
    a, b = AIRY
    e2, n = 1 - b * b / (a * a), (a - b) / (a + b)
    m = [1 + n + 5 / 4 * n**2 + 5 / 4 * n**3, 3 * n + 3 * n**2 + 21 / 8 * n**3, 15 / 8 * n**2 + 15 / 8 * n**3, 35 / 24 * n**3]
    return [
        ("dp", f"phi - radians({num(LAT0)})"), ("sp", f"phi + radians({num(LAT0)})"), ("dl", f"lam - radians({num(LON0)})"),
        ("si", "sin(phi)"), ("co", "cos(phi)"), ("t2", "tan(phi) * tan(phi)"), ("w", f"1e0 - {num(e2)} * si * si"),
        ("nu", f"{num(a * SCALE)} / sqrt(w)"), ("ratio", f"w / {num(1 - e2)}"), ("eta2", "ratio - 1e0"),
        ("arc", f"{num(b * SCALE)} * ({num(m[0])} * dp - {num(m[1])} * sin(dp) * cos(sp) + {num(m[2])} * sin(2e0 * dp) * cos(2e0 * sp) - {num(m[3])} * sin(3e0 * dp) * cos(3e0 * sp))"),
        ("north", f"arc + {num(NORTH0)} + dl * dl * nu * si * co * (0.5e0 + dl * dl * co * co / 24e0 * (5e0 - t2 + 9e0 * eta2) + dl * dl * dl * dl * co * co * co * co / 720e0 * (61e0 - 58e0 * t2 + t2 * t2))"),
        ("east", f"{num(EAST0)} + dl * nu * co * (1e0 + dl * dl * co * co / 6e0 * (ratio - t2) + dl * dl * dl * dl * co * co * co * co / 120e0 * (5e0 - 18e0 * t2 + t2 * t2 + 14e0 * eta2 - 58e0 * t2 * eta2))"),
    ]


def to_grid(df: DataFrame, lat: str, lon: str, crs: int = 4326) -> DataFrame:
    """Adds ``east`` and ``north`` for WGS 84 degrees; places on the grid already (27700) stay. Nulls give nulls; other systems: ValueError."""
    if crs not in KNOWN:
        raise ValueError(f"unknown coordinate system {crs}")
    if crs == 27700:
        return df.withColumns({"east": F.col(lon).cast("double"), "north": F.col(lat).cast("double")})
    out, made = df, []
    for name, step in [*shift_steps(lat, lon), *grid_steps()]:
        for x in sorted(made, key=len, reverse=True):
            step = replaced(step, x)
        out, made = out.withColumn(f"_g_{name}", F.expr(step)), [*made, name]
    return out.withColumnsRenamed({"_g_east": "east", "_g_north": "north"}).drop(*(f"_g_{x}" for x in made))


def replaced(step: str, name: str) -> str:
    """The step with a name of an earlier one under its column's name."""
    return re.sub(rf"(?<![\w.]){name}(?![\w(])", f"_g_{name}", step)


def grid_sql(source: str, lat: str, lon: str) -> str:
    """The same steps as nested SQL."""
    sql = source
    for name, step in [*shift_steps(lat, lon), *grid_steps()]:
        sql = f"(SELECT *, {step} AS {name} FROM {sql})"
    return sql
