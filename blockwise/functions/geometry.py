"""Planar geometry as native Column expressions.

Polygons are handled as edge lists; the even-odd rule over all rings of all
parts gives holes and multipolygons for free.  The projection is the Lambert
conformal conic of Snyder, *Map Projections: A Working Manual* (USGS
Professional Paper 1395, 1987), eqs. 15-1 .. 15-10, 14-15.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# EPSG:2263, NAD83 / New York Long Island (US survey feet).
# GRS 1980 ellipsoid; standard parallels 41 02' N and 40 40' N; latitude of
# origin 40 10' N; central meridian 74 W; false easting 300000 m.
LCC_NY_LONG_ISLAND = {
    "a": 6378137.0,
    "inv_f": 298.257222101,
    "lat1": 41.0 + 2.0 / 60.0,
    "lat2": 40.0 + 40.0 / 60.0,
    "lat0": 40.0 + 10.0 / 60.0,
    "lon0": -74.0,
    "false_easting_m": 300000.0,
    "false_northing_m": 0.0,
    "unit_m": 1200.0 / 3937.0,  # one US survey foot in metres
}
# ---------------------------------------------------------------------------


def lcc_constants(p: dict = LCC_NY_LONG_ISLAND) -> dict:
    """Projection constants n, F*a, rho0, e (computed once on the driver)."""
    f = 1.0 / p["inv_f"]
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / (
            ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2))

    p1, p2, p0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    af = p["a"] * big_f
    return {"e": e, "n": n, "aF": af, "rho0": af * t(p0) ** n,
            "lon0": math.radians(p["lon0"]), "fe": p["false_easting_m"],
            "fn": p["false_northing_m"], "unit": p["unit_m"]}


def project_lcc(lon: Column | str, lat: Column | str, params: dict = LCC_NY_LONG_ISLAND
                ) -> tuple[Column, Column]:
    """(lon, lat) in degrees -> (x, y) in the projection's units."""
    k = lcc_constants(params)
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    phi = F.radians(lat)
    es = F.lit(k["e"]) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es),
                                                    F.lit(k["e"] / 2))
    rho = F.lit(k["aF"]) * F.pow(t, F.lit(k["n"]))
    theta = F.lit(k["n"]) * (F.radians(lon) - F.lit(k["lon0"]))
    x = (rho * F.sin(theta) + F.lit(k["fe"])) / F.lit(k["unit"])
    y = (F.lit(k["rho0"]) - rho * F.cos(theta) + F.lit(k["fn"])) / F.lit(k["unit"])
    return x, y


def edge_crossed(e: Column, px: Column, py: Column) -> Column:
    """A ray from (px, py) towards +x crosses edge struct ``e`` (x1, y1, x2, y2).

    Half-open in y, so a ray through a vertex counts it once.
    """
    straddles = (e["y1"] > py) != (e["y2"] > py)
    x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    # ``when`` keeps the division away from horizontal edges.
    return F.when(straddles, px < x_at).otherwise(F.lit(False))


def on_edge(e: Column, px: Column, py: Column) -> Column:
    """(px, py) lies on edge struct ``e`` (collinear and within its box)."""
    collinear = (px - e["x1"]) * (e["y2"] - e["y1"]) == (py - e["y1"]) * (e["x2"] - e["x1"])
    return (collinear & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def crossings(edges: Column, px: Column, py: Column) -> Column:
    """Number of edges a ray from (px, py) towards +x crosses (even-odd rule)."""
    return F.size(F.filter(edges, lambda e: edge_crossed(e, px, py)))


def on_boundary(edges: Column, px: Column, py: Column) -> Column:
    """True when (px, py) lies on one of the edges."""
    return F.exists(edges, lambda e: on_edge(e, px, py))


def contains(edges: Column, px: Column, py: Column) -> Column:
    """Strict point-in-polygon: odd crossings and not on the boundary."""
    return ((crossings(edges, px, py) % 2) == 1) & ~on_boundary(edges, px, py)


# The same tests as SQL text.  A lambda built through the Column API costs
# hundreds of Py4J round trips; as text it is one ``expr`` call.  The
# arithmetic is written in the same order as above, so results are equal.
def crossings_sql(edges: str, px: str, py: str, var: str = "_e") -> str:
    """SQL for ``crossings``: ``edges`` an array<struct<x1,y1,x2,y2>> expression."""
    e = var
    return (f"size(filter({edges}, {e} -> CASE WHEN ({e}.y1 > {py}) <> ({e}.y2 > {py}) "
            f"THEN {px} < ({e}.x2 - {e}.x1) * ({py} - {e}.y1) / ({e}.y2 - {e}.y1) + {e}.x1 "
            f"ELSE false END))")


def on_boundary_sql(edges: str, px: str, py: str, var: str = "_e") -> str:
    """SQL for ``on_boundary``."""
    e = var
    return (f"exists({edges}, {e} -> ({px} - {e}.x1) * ({e}.y2 - {e}.y1) = "
            f"({py} - {e}.y1) * ({e}.x2 - {e}.x1) "
            f"AND {px} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2) "
            f"AND {py} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2))")


def contains_sql(edges: str, px: str, py: str) -> str:
    """SQL for ``contains``."""
    return (f"({crossings_sql(edges, px, py)} % 2 = 1 "
            f"AND NOT {on_boundary_sql(edges, px, py)})")


def cell_contains_sql(zone: str, right: str, base: str, px: str, py: str) -> str:
    """SQL for "the zone holds the point", from what one grid cell knows of the zone.

    ``zone`` has ``edges`` (all that touch the cell) and ``odd``: whether an odd number of the
    others, right of the cell, cross the line y = ``base`` at the cell's bottom.  Between that
    line and the point's own the number of others changes only where one of them ends, right
    of the cell (x > ``right``); at such a vertex as many of the cell's edges end, by parity,
    as a closed ring has two edges at each vertex.  So the parity at the point is ``odd``, the
    crossings of the cell's edges, and their ends between the two lines.  Only comparisons
    decide which edges count: the answer is that of the test over all edges.
    """
    e = "_e"
    ends = " + ".join(f"CAST({e}.x{i} > {right} AND ({e}.y{i} > {base}) <> ({e}.y{i} > {py}) AS INT)" for i in (1, 2))
    moved = f"aggregate({zone}.edges, 0, (_n, {e}) -> _n + {ends})"
    return (f"(({crossings_sql(f'{zone}.edges', px, py)} + {moved} + CAST({zone}.odd AS INT)) % 2 = 1 "
            f"AND NOT {on_boundary_sql(f'{zone}.edges', px, py)})")
