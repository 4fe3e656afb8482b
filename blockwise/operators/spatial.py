"""Point-in-polygon assignment through a grid-cell equi-join.

The polygon layer (edges: zone_id, x1, y1, x2, y2, attributes) is turned into
a *cell table* keyed by integer grid cell (gx, gy).  For every grid row of a
zone, each edge is clipped to the row band; a column that a clipped edge
passes through is a *boundary* cell and keeps that edge.  A running sum over
the row's columns, from the right, gives every boundary cell the parity of the
edges that lie right of it, which is all a point test needs besides the cell's
own edges (see ``cell_contains_sql``); columns between two boundary cells are
wholly inside or wholly outside by the same parity, inside ones are *interior*
cells, outside ones dropped.

Each cell row holds its candidate zones sorted by id and, when the lowest-id
candidate is interior, that zone as the cell's ``sure`` answer.  Points
compute their cell with two ``floor`` calls and meet the cell table in an
equi-join; a point in a cell with a sure zone needs no test, the others run
the exact even-odd test (higher-order functions over the cell's few edges),
and the first matching zone (lowest id) wins.  With the cell table broadcast
(after a size check) the whole assignment is map-only: no shuffle of points
at all, whatever their skew.  Beyond the bound the join shuffles on the cell
key, salted, and AQE splits what remains skewed; counting jobs first count the
points of each exact coordinate (``weighted``), so a repeated one is one row.

The cell table is built by Spark from the edge list (layer-sized work: one
aggregation per cell and zone, one window over the cells of a zone row, one
aggregation per cell).  Edges are gathered by cell, never by zone or row.
``quadtree.QuadIndex`` is the form for layers that one grid step does not fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwise.functions.geometry import LCC_NY_LONG_ISLAND, cell_contains_sql, project_lcc
from blockwise.operators.sizing import DEFAULT_BROADCAST_ROWS

EDGE_COLUMNS = ("zone_id", "x1", "y1", "x2", "y2")
EDGES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def layer_stats(layers: dict[str, DataFrame]) -> dict[str, dict]:
    """Zone-bbox summaries of several layers in one small job.

    Per layer: zone count, sums of bbox area and half-perimeter, largest
    width/height, and A = sum(w*h*(E+1)), B = sum((w+h)*(E+1)), C = sum(E+1)
    over zones with E edges, from which ``entry_bound`` bounds the cell
    table's size for any cell size.  One row per layer reaches the driver.
    """
    tagged = None
    for name, e in layers.items():
        t = e.select(F.lit(name).alias("_layer"), *EDGE_COLUMNS)
        tagged = t if tagged is None else tagged.unionByName(t)
    z = tagged.groupBy("_layer", "zone_id").agg(
        (F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))).alias("w"),
        (F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("h"),
        (F.count(F.lit(1)) + 1).alias("e1"))
    w, h, e1 = F.col("w"), F.col("h"), F.col("e1")
    rows = z.groupBy("_layer").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w * h).alias("area"),
        F.sum(w + h).alias("perim"), F.max("w").alias("max_w"), F.max("h").alias("max_h"),
        F.sum(w * h * e1).alias("A"), F.sum((w + h) * e1).alias("B"),
        F.sum(e1).alias("C")).collect()
    return {r["_layer"]: {k: v for k, v in r.asDict().items() if k != "_layer"} for r in rows}


def _bbox_stats(edges: DataFrame) -> dict:
    return layer_stats({"layer": edges}).get("layer", {"n": 0, "area": 0.0, "perim": 0.0,
                                                       "max_w": 0.0, "max_h": 0.0,
                                                       "A": 0.0, "B": 0.0, "C": 0})


def entry_bound(stats: dict, cell_size: float) -> float:
    """Upper bound on the cell table's entries (zone rows + listed edges).

    A zone's bbox covers at most (w/s + 3)(h/s + 3) cells and lists at most
    its E edges plus one row in each, so entries <= A/s^2 + 3B/s + 9C.
    """
    s = cell_size
    return (float(stats["A"] or 0) / (s * s) + 3 * float(stats["B"] or 0) / s
            + 9 * float(stats["C"] or 0))


def choose_cell_size(stats: dict, cells_per_zone: int = 256, cells_per_edge: int = 4,
                     min_cells: int = 32_768, broadcast_rows: int | None = None,
                     least_cells_per_zone: int = 4) -> float:
    """Grid step for about ``cells_per_zone`` cells per zone bbox.

    The step follows zone and edge density alone (``cells_per_edge`` per
    polygon edge, so a boundary cell lists few edges; at least ``min_cells``
    in all), whatever the number of zones.  Where a somewhat coarser grid lets
    the cell table be broadcast (``entry_bound`` within ``broadcast_rows``) the
    step grows, but never beyond ``least_cells_per_zone`` cells per zone: past
    that the join shuffles, and a cell keeps a bounded number of zones.
    """
    n = max(int(stats["n"] or 0), 1)
    area = float(stats["area"] or 0.0)
    edges = float(stats.get("C") or 0.0)
    target = max(n * cells_per_zone, edges * cells_per_edge, min_cells)
    side = max(float(stats["max_w"] or 0.0), float(stats["max_h"] or 0.0), 1e-9)
    s = math.sqrt(area / target) if area > 0 else side / math.sqrt(cells_per_zone)
    s = max(s, side * 1e-6)
    if broadcast_rows is not None and area > 0:
        coarsest = math.sqrt(area / (n * least_cells_per_zone))
        step = s
        while entry_bound(stats, step) > broadcast_rows and step * 1.25 <= coarsest:
            step *= 1.25
        if entry_bound(stats, step) <= broadcast_rows:
            s = step
    return s


class ZoneIndex:
    """A polygon layer prepared for point assignment.

    ``edges``      DataFrame with zone_id, x1, y1, x2, y2 and optional
                   attribute columns (constant per zone)
    ``attrs``      attribute columns carried into results
    ``cell_size``  grid step; default from the zone bboxes (one small job,
                   or ``stats`` from ``layer_stats`` shared by several layers)
    ``salt``       when the cell table is too large to broadcast, every cell
                   row is replicated ``salt`` times and each point goes to one
                   replica chosen by a hash of its columns, so a cell holding a
                   third of all points is spread over ``salt`` tasks (AQE's
                   skew-join splitting comes on top)
    """

    def __init__(self, edges: DataFrame, *, attrs: Sequence[str] = ("zone_name",),
                 cell_size: float | None = None, cells_per_zone: int = 256,
                 broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                 broadcast: bool | None = None, salt: int = 16, stats: dict | None = None):
        self.salt = max(int(salt), 1)
        self.attrs = [a for a in attrs if a in edges.columns]
        self.edges = edges.select(*EDGE_COLUMNS, *self.attrs)
        self._broadcast_rows = broadcast_rows
        self._broadcast = broadcast
        if cell_size is None:
            stats = stats if stats is not None else _bbox_stats(self.edges)
            cell_size = choose_cell_size(stats, cells_per_zone, broadcast_rows=broadcast_rows)
            # A proven bound under the limit settles the broadcast without
            # building the cell table an extra time.
            if broadcast is None and broadcast_rows is not None and \
                    entry_bound(stats, cell_size) <= broadcast_rows:
                self._broadcast = True
        self.cell_size = float(cell_size)
        self.cells = self._build_cells()

    # -- cell table ---------------------------------------------------------
    def _build_cells(self) -> DataFrame:
        """Cell table from the edge list: scanline parity by a running sum over each zone row.

        Within one grid row of a zone, every edge belongs to the columns its
        (slightly widened) box within the row touches.  If it crosses the row's
        bottom line it is an event at the first of these columns: the number of
        events right of a column is the number of edges right of it that cross
        the line.  The running sum streams over a row's cells; it also decides
        the columns between two boundary cells, which no edge touches.
        """
        s = self.cell_size
        eps = s * 1e-6  # widen edge boxes so rounding never hides an edge
        lo_x, hi_x = F.least("x1", "x2"), F.greatest("x1", "x2")
        lo_y, hi_y = F.least("y1", "y2"), F.greatest("y1", "y2")
        e = self.edges.select(
            "zone_id", *self.attrs,
            F.struct("x1", "y1", "x2", "y2").alias("edge"),
            F.floor((lo_x - eps) / s).alias("cx0"), F.floor((hi_x + eps) / s).alias("cx1"),
            F.floor((lo_y - eps) / s).alias("cy0"), F.floor((hi_y + eps) / s).alias("cy1"))
        # An edge belongs to every grid row its y extent spans; within a row
        # only the part of the edge inside the (widened) row band counts, so
        # its columns come from x at the band's bottom and top.
        per_row = e.select("zone_id", *self.attrs, "edge", "cx0", "cx1",
                           F.explode(F.sequence("cy0", "cy1")).alias("gy"))
        x1, y1 = F.col("edge.x1"), F.col("edge.y1")
        x2, y2 = F.col("edge.x2"), F.col("edge.y2")
        band_lo = F.greatest(F.least(y1, y2), F.col("gy").cast("double") * F.lit(s) - F.lit(eps))
        band_hi = F.least(F.greatest(y1, y2),
                          (F.col("gy").cast("double") + F.lit(1.0)) * F.lit(s) + F.lit(eps))

        def x_at(yv):
            return x1 + (x2 - x1) * (yv - y1) / (y2 - y1)
        flat = y1 == y2
        xa = F.when(flat, F.least(x1, x2)).otherwise(x_at(band_lo))
        xb = F.when(flat, F.greatest(x1, x2)).otherwise(x_at(band_hi))
        per_row = per_row.select(
            "zone_id", *self.attrs, "edge", "gy",
            F.greatest(F.col("cx0"), F.floor((F.least(xa, xb) - eps) / s)).alias("rx0"),
            F.least(F.col("cx1"), F.floor((F.greatest(xa, xb) + eps) / s)).alias("rx1"))
        base = F.col("gy").cast("double") * F.lit(s)
        crosses = (y1 > base) != (y2 > base)
        touched = per_row.select("zone_id", *self.attrs, "gy", "edge", "rx0", crosses.alias("crosses"),
                                 F.explode(F.sequence("rx0", "rx1")).alias("gx"))
        boundary = touched.groupBy("zone_id", "gy", "gx").agg(
            F.collect_list("edge").alias("edges"),
            F.count_if(F.col("crosses") & (F.col("gx") == F.col("rx0"))).alias("events"),
            *[F.first(a, ignorenulls=True).alias(a) for a in self.attrs])
        from_right = Window.partitionBy("zone_id", "gy").orderBy(F.col("gx").desc())
        events = F.sum("events").over(from_right.rowsBetween(Window.unboundedPreceding, -1))
        scanned = boundary.select("*", (F.coalesce(events, F.lit(0)) % 2 == 1).alias("odd"),
                                  F.lag("gx").over(from_right).alias("next_gx"))
        # A boundary cell, and the interior cells between it and the next one.
        cells = scanned.withColumn("c", F.explode(F.expr(
            "concat(array(struct(gx, false AS interior)), "
            "CASE WHEN odd AND next_gx > gx + 1 THEN transform(sequence(gx + 1, next_gx - 1), _g -> struct(_g AS gx, true AS interior)) "
            "ELSE CAST(array() AS array<struct<gx:bigint,interior:boolean>>) END)")))
        interior = F.col("c.interior")
        zone = F.struct("zone_id", *self.attrs, interior.alias("interior"), F.col("odd"),
                        F.when(interior, F.array().cast(EDGES_TYPE)).otherwise(F.col("edges")).alias("edges"))
        by_cell = cells.select(F.col("c.gx").alias("gx"), "gy", zone.alias("z")) \
                       .groupBy("gx", "gy").agg(F.array_sort(F.collect_list("z")).alias("zones"))
        # Underscored names: the table is joined next to the caller's columns.
        return by_cell.select(F.col("gx").alias("_cell_gx"), F.col("gy").alias("_cell_gy"),
                              ((F.col("gx").cast("double") + 1.0) * F.lit(s)).alias("_right"),
                              (F.col("gy").cast("double") * F.lit(s)).alias("_base"),
                              F.col("zones").alias("_zones"), self._sure().alias("_sure"))

    def _sure(self) -> Column:
        """The lowest-id candidate of ``zones`` where it covers the whole cell: no test there (the common case)."""
        first = F.col("zones").getItem(0)
        return F.when(first["interior"], F.struct(first["zone_id"].alias("zone_id"),
                                                  *[first[a].alias(a) for a in self.attrs]))

    def cell_stats(self) -> dict:
        """Rows and edge entries of the cell table (one small job)."""
        r = self.cells.agg(
            F.count(F.lit(1)).alias("cells"),
            F.sum(F.aggregate("_zones", F.lit(0), lambda acc, z: acc + F.size(z["edges"]) + 1))
            .alias("entries")).first()
        return {"cells": int(r["cells"]), "entries": int(r["entries"] or 0)}

    @property
    def is_broadcast(self) -> bool:
        """Whether points meet the cell table without a shuffle (its size is counted once if no bound proved it)."""
        if self._broadcast is None:
            self._broadcast = self._broadcast_rows is not None and self.cell_stats()["entries"] <= self._broadcast_rows
        return self._broadcast

    def _join_side(self) -> DataFrame:
        return F.broadcast(self.cells) if self.is_broadcast else self.cells

    @classmethod
    def build_many(cls, layers: dict[str, DataFrame], **kw) -> dict[str, "ZoneIndex"]:
        """Indexes for several layers with their statistics from one job."""
        stats = layer_stats(layers)
        return {name: cls(e, stats=stats.get(name), **kw) for name, e in layers.items()}

    # -- assignment ---------------------------------------------------------
    def assign(self, points: DataFrame, *, x: str, y: str, carry: Sequence[str] = (),
               prefix: str = "", how: str = "left", match: str = "first") -> DataFrame:
        """Add ``<prefix>zone_id`` (and carried attributes) to every point.

        ``how='left'`` keeps points in no zone with null; ``'inner'`` drops
        them.  ``match='first'`` resolves overlapping zones to the lowest zone
        id (one row per point); ``match='all'`` gives one row per containing
        zone.  Points on an edge are outside.
        """
        if match not in ("first", "all"):
            raise ValueError("match must be 'first' or 'all'")
        located = self._locate(points, x, y, how)
        return self._resolve(located, points.columns, x, y, carry, prefix, how, match)

    @staticmethod
    def _finite(x: str, y: str) -> Column:
        # NaN or infinite coordinates get no cell (floor(NaN) would be cell 0).
        return ~F.isnan(F.col(x)) & ~F.isnan(F.col(y)) & \
            (F.abs(F.col(x)) < F.lit(float("inf"))) & (F.abs(F.col(y)) < F.lit(float("inf")))

    def _salted(self, pts: DataFrame, cells: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, Column | None]:
        """In the shuffle form: points and cells with a salt, and the condition on it."""
        if self.is_broadcast or self.salt <= 1:
            return pts, cells, None
        # Deterministic salt (a hash of the point's columns), so a retried
        # task sends every point to the same replica again.
        pts = pts.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(self.salt)))
        cells = cells.withColumn("_cell_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.salt - 1).cast("long"))))
        return pts, cells, pts["_salt"] == cells["_cell_salt"]

    def _locate(self, points: DataFrame, x: str, y: str, how: str) -> DataFrame:
        """Points beside the row of their cell."""
        s, finite = self.cell_size, self._finite(x, y)
        pts = points.withColumn("_gx", F.when(finite, F.floor(F.col(x) / F.lit(s)))) \
                    .withColumn("_gy", F.when(finite, F.floor(F.col(y) / F.lit(s))))
        pts, cells, salted = self._salted(pts, self._join_side(), points.columns)
        cond = (pts["_gx"] == cells["_cell_gx"]) & (pts["_gy"] == cells["_cell_gy"])
        return pts.join(cells, cond if salted is None else cond & salted, "inner" if how == "inner" else "left")

    def _resolve(self, located: DataFrame, columns: Sequence[str], x: str, y: str, carry: Sequence[str],
                 prefix: str, how: str, match: str) -> DataFrame:
        """The zones of points that stand beside their cell."""
        test = cell_contains_sql("_z", "_right", "_base", f"`{x}`", f"`{y}`")
        hits = F.expr(f"filter(_zones, _z -> _z.interior OR {test})")
        found = F.transform(hits, lambda z: F.struct(
            z["zone_id"].alias("zone_id"), *[z[a].alias(a) for a in self.attrs]))
        if match == "first":
            # The lambda test (interpreted by Spark) runs only where the cell
            # has no sure zone.
            found = F.when(F.col("_sure").isNotNull(), F.array(F.col("_sure"))) \
                     .otherwise(F.slice(found, 1, 1))
        # A generator materialises the match once: later projections and the
        # inner join's null test read the column instead of re-running the
        # test (a plain filter would be pushed below the projection).
        gen = F.explode_outer if how != "inner" else F.explode
        out = located.select(*[F.col(c) for c in columns], gen(found).alias("_hit"))
        return out.select(*[F.col(c) for c in columns], F.col("_hit.zone_id").alias(f"{prefix}zone_id"),
                          *[F.col(f"_hit.{a}").alias(f"{prefix}{a}") for a in carry])


def weighted(points: DataFrame, columns: Sequence[str], indexes: Sequence[ZoneIndex], weight: str) -> DataFrame:
    """``columns`` of the points with a count, for jobs that only count points.

    Where one of the ``indexes`` joins by a shuffle, rows that agree in all ``columns`` are
    counted first, so however often a coordinate stands among the points, one row of it is
    shuffled and tested; the counts are partial before that shuffle.  Points that meet every
    index in place need no shuffle, and each counts 1.
    """
    pts = points.select(*columns)
    if all(ix.is_broadcast for ix in indexes):
        return pts.withColumn(weight, F.lit(1).cast("long"))
    return pts.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


def edges_from_rings(zones: DataFrame, *, id_col: str = "zone_id",
                     rings_col: str = "rings", attrs: Sequence[str] = ()) -> DataFrame:
    """Polygon rings -> edge rows.

    ``rings_col`` is ``array<array<struct<x,y>>>``: every ring of every part
    (outer rings and holes alike).  Consecutive vertices form an edge; a ring
    that is not closed is closed implicitly.
    """
    r = zones.select(F.col(id_col).alias("zone_id"), *attrs,
                     F.explode(F.col(rings_col)).alias("ring"))
    n = F.size("ring")
    r = r.where(n >= 3).select(
        "zone_id", *attrs, "ring",
        F.posexplode(F.col("ring")).alias("i", "p"))
    nxt = F.element_at(F.col("ring"), ((F.col("i") + 1) % F.size("ring")) + 1)
    return r.select("zone_id", *attrs, F.col("p.x").alias("x1"), F.col("p.y").alias("y1"),
                    nxt["x"].alias("x2"), nxt["y"].alias("y2")) \
            .where(~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))))



def assign_zone(points: DataFrame, zones: ZoneIndex | DataFrame, *, x: str, y: str,
                carry: Sequence[str] = (), how: str = "left", match: str = "first",
                cell_size: float | None = None) -> DataFrame:
    """Functional form of ``ZoneIndex.assign`` (``zones`` may be an edge list)."""
    if not isinstance(zones, ZoneIndex):
        zones = ZoneIndex(zones, attrs=carry, cell_size=cell_size)
    return zones.assign(points, x=x, y=y, carry=carry, how=how, match=match)


def project_edges(edges: DataFrame, params: dict = LCC_NY_LONG_ISLAND) -> DataFrame:
    """P16 for a layer: both end points of every edge (lon/lat degrees) to
    planar coordinates, so containment is tested in the projected plane."""
    x1, y1 = project_lcc("x1", "y1", params)
    x2, y2 = project_lcc("x2", "y2", params)
    others = [c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")]
    return edges.select(*others, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def project_points(points: DataFrame, lon: str, lat: str, *, x: str = "x", y: str = "y",
                   params: dict = LCC_NY_LONG_ISLAND) -> DataFrame:
    """P16 for points: add planar ``x``, ``y`` computed from ``lon``, ``lat``."""
    px, py = project_lcc(lon, lat, params)
    return points.withColumn(x, px).withColumn(y, py)
