"""Point-in-polygon assignment over cells of several sizes (J4 for mixed layers).

One grid step cannot fit a layer that mixes a country with city blocks: fine
cells inside the country are too many, coarse cells hold too many blocks.  Here
the layer's bounding square is split into 4 x 4 cells, and every cell that more
than ``max_edges`` edges touch is split again, so the leaves partition the
square, and no leaf (but one of the finest level) is touched by more edges.  A
big polygon is one entry in each leaf it covers, coarse ones in its inside, and
leaves are no more than the edges ask for.

Level by level, every edge of a split cell is clipped to the cell's four rows of
children and gives each row a mask of the columns left of it (if it crosses the
row's bottom line) and of the columns it touches; XOR and OR of the masks by
zone give every child the parity ``cell_contains_sql`` needs, and whether it is
wholly inside.  These are plain aggregations with partial sums: a polygon of any
number of edges is never gathered; edges are gathered by leaf at the end.  Each
level is a stored table, so a level costs the edges of its split cells alone.

A point has one key a level, and exactly one of them is a leaf: its keys meet
the leaves in one equi-join, broadcast when the leaves are few enough.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockwise.operators.sizing import DEFAULT_BROADCAST_ROWS, row_count_at_most
from blockwise.operators.spatial import EDGE_COLUMNS, EDGES_TYPE, ZoneIndex
from blockwise.scratch import stored

#: Bits of a cell's column and row in its key; levels have 4 ** level cells a side.
KEY_BITS = 28
MAX_LEVEL = 10


def cell_key(level: int, gx: Column, gy: Column) -> Column:
    return (F.lit(level << (2 * KEY_BITS)) + F.shiftleft(gx.cast("long"), KEY_BITS) + gy.cast("long")).cast("long")


class QuadIndex(ZoneIndex):
    """A polygon layer prepared for point assignment, by leaves of several sizes.

    Same results and the same ``assign`` as ``ZoneIndex``.  ``max_edges`` bounds the edges of a
    leaf, except at ``max_level``, the finest (a vertex where more edges meet).  Building runs
    one small group of jobs a level and keeps the leaves as a stored table.
    """

    def __init__(self, edges: DataFrame, *, attrs: Sequence[str] = ("zone_name",), max_edges: int = 64,
                 max_level: int = MAX_LEVEL, broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                 broadcast: bool | None = None, salt: int = 16):
        if not 0 <= max_level <= KEY_BITS // 2:
            raise ValueError(f"max_level must be within 0 and {KEY_BITS // 2}")
        self.salt = max(int(salt), 1)
        self.attrs = [a for a in attrs if a in edges.columns]
        self.edges = edges.select(*EDGE_COLUMNS, *self.attrs)
        self.max_edges, self.max_level = max_edges, max_level
        self._broadcast_rows, self._broadcast = broadcast_rows, broadcast
        box = self.edges.agg(F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x1"),
                             F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y1")).first()
        self.x0, self.y0 = box["x0"] or 0.0, box["y0"] or 0.0
        wide = max((box["x1"] or 0.0) - self.x0, (box["y1"] or 0.0) - self.y0, 1e-300)
        # A power of two, so that cells of one level nest exactly in those of another.
        self.side = 2.0 ** (math.floor(math.log2(wide)) + 1)
        self.cells = self._build_cells()

    def _step(self, level: int) -> float:
        return self.side / 4.0 ** level

    def _slack(self, level: int) -> float:
        """How far an edge's box is widened, so that rounding never hides an edge from a cell."""
        return max(1e-6 * self._step(level), 4e-12 * max(abs(self.x0), abs(self.y0), self.side))

    def _build_cells(self) -> DataFrame:
        spark = self.edges.sparkSession
        one = F.lit(0).cast("long")
        active = stored(self.edges.select(one.alias("gx"), one.alias("gy"), F.lit(False).alias("odd"), "*"), "quad-edges")
        inside = active.select("gx", "gy", "zone_id", *self.attrs).limit(0)
        cells = spark.range(1).select(one.alias("gx"), one.alias("gy"))
        levels, self.levels = [], []
        for level in range(self.max_level + 1):
            full = active.groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > self.max_edges).select("gx", "gy")
            full = stored(full, "quad-split") if level < self.max_level else full.limit(0)
            leaves = cells.join(full, ["gx", "gy"], "left_anti")
            levels.append(self._leaf_table(level, leaves, active.join(full, ["gx", "gy"], "left_anti"), inside))
            self.levels.append(level)
            if level == self.max_level or full.isEmpty():
                break
            cells = self._children(full)
            split = self._small(full)
            active, inside = self._split(level, *(t.join(split, ["gx", "gy"], "left_semi") for t in (active, inside)))
        table = levels[0]
        for t in levels[1:]:
            table = table.unionByName(t)
        return stored(table, "quad-leaves")

    @staticmethod
    def _small(df: DataFrame) -> DataFrame:
        """Broadcast a side of few rows: then no cell or zone with many edges meets in one task."""
        return F.broadcast(df) if row_count_at_most(df, 200_000) else df

    @staticmethod
    def _children(cells: DataFrame) -> DataFrame:
        child = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_c")
        others = [c for c in cells.columns if c not in ("gx", "gy")]
        return cells.select("*", child).select((F.col("gx") * 4 + F.col("_c") % 4).alias("gx"),
                                               (F.col("gy") * 4 + F.floor(F.col("_c") / 4)).alias("gy"), *others)

    def _split(self, level: int, active: DataFrame, inside: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Edges by the children they touch, with each child's parity, and the zones that cover a child."""
        s, slack = self._step(level + 1), self._slack(level + 1)
        x0, y0 = (f"CAST('{v!r}' AS DOUBLE)" for v in (self.x0, self.y0))
        step, eps = f"CAST('{s!r}' AS DOUBLE)", f"CAST('{slack!r}' AS DOUBLE)"
        rows = active.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("cy"))
        rows = rows.select("*", F.expr(f"CAST(gy * 4 + cy AS DOUBLE) * {step} + {y0}").alias("base"),
                           F.expr(f"CAST(gy * 4 AS DOUBLE) * {step} + {y0}").alias("floor_"),
                           F.expr(f"CAST(gx * 4 + 4 AS DOUBLE) * {step} + {x0}").alias("edge_right"))
        # The part of the edge within the widened row, and the columns that part touches.
        rows = rows.select("*", F.expr(f"greatest(least(y1, y2), base - {eps})").alias("low"),
                           F.expr(f"least(greatest(y1, y2), base + {step} + {eps})").alias("high"))
        at = "CASE WHEN y1 = y2 THEN {flat} ELSE x1 + (x2 - x1) * ({y} - y1) / (y2 - y1) END"
        rows = rows.select("*", F.expr(at.format(flat="least(x1, x2)", y="low")).alias("xa"),
                           F.expr(at.format(flat="greatest(x1, x2)", y="high")).alias("xb"))
        column = f"CAST(floor(({{x}} - {x0}) / {step}) - gx * 4 AS INT)"
        first = column.format(x=f"greatest(least(x1, x2), least(xa, xb)) - {eps}")
        last = column.format(x=f"least(greatest(x1, x2), greatest(xa, xb)) + {eps}")
        rows = rows.select("*", F.expr("low <= high").alias("meets"), F.expr(f"greatest(0, least(4, {first}))").alias("c0"),
                           F.expr(f"greatest(-1, least(3, {last}))").alias("c1"))
        crossing = "CASE WHEN meets AND (y1 > base) <> (y2 > base) THEN shiftleft(1, c0) - 1 ELSE 0 END"
        ends = " ^ ".join(f"CASE WHEN x{i} > edge_right AND (y{i} > floor_) <> (y{i} > base) THEN 15 ELSE 0 END" for i in (1, 2))
        touch = "CASE WHEN meets AND c0 <= c1 THEN shiftleft(1, c1 + 1) - shiftleft(1, c0) ELSE 0 END"
        rows = stored(rows.select("gx", "gy", "odd", *EDGE_COLUMNS, *self.attrs, "cy",
                                  F.expr(f"{crossing} ^ {ends}").alias("flip"), F.expr(touch).alias("touch")), "quad-rows")
        key = ["gx", "gy", "zone_id", "cy"]
        masks = rows.groupBy(*key).agg(F.bit_xor("flip").alias("flips"), F.bit_or("touch").alias("touched"),
                                       F.first("odd").alias("was"), *[F.first(a, ignorenulls=True).alias(a) for a in self.attrs])
        masks = stored(masks.withColumn("odds", F.expr("flips ^ CASE WHEN was THEN 15 ELSE 0 END")), "quad-masks")
        bits = "explode(filter(sequence(0, 3), _b -> shiftright({mask}, _b) % 2 = 1))"
        place = [(F.col("gx") * 4 + F.col("cx")).alias("gx"), (F.col("gy") * 4 + F.col("cy")).alias("gy")]
        touching = rows.where("touch <> 0").select("*", F.expr(bits.format(mask="touch")).alias("cx"))
        touching = touching.join(self._small(masks.where("touched <> 0").select(*key, "odds")), key)
        touching = touching.select(*place, (F.expr("shiftright(odds, cx) % 2 = 1")).alias("odd"), *EDGE_COLUMNS, *self.attrs)
        covered = masks.select("*", F.expr(bits.format(mask="(odds & ~touched & 15)")).alias("cx")).select(*place, "zone_id", *self.attrs)
        return stored(touching, "quad-edges"), stored(covered.unionByName(self._children(inside)), "quad-inside")

    def _leaf_table(self, level: int, leaves: DataFrame, active: DataFrame, inside: DataFrame) -> DataFrame:
        """Leaf cells of a level with their candidate zones (none: an empty list)."""
        s = self._step(level)
        edge = F.struct("x1", "y1", "x2", "y2")
        touched = active.groupBy("gx", "gy", "zone_id").agg(F.first("odd").alias("odd"), F.collect_list(edge).alias("edges"),
                                                            *[F.first(a, ignorenulls=True).alias(a) for a in self.attrs])
        touched = touched.select("gx", "gy", F.struct("zone_id", *self.attrs, F.lit(False).alias("interior"), "odd", "edges").alias("z"))
        covered = inside.select("gx", "gy", F.struct("zone_id", *self.attrs, F.lit(True).alias("interior"), F.lit(True).alias("odd"),
                                                     F.array().cast(EDGES_TYPE).alias("edges")).alias("z"))
        zones = touched.unionByName(covered).groupBy("gx", "gy").agg(F.array_sort(F.collect_list("z")).alias("zones"))
        none = F.array().cast(zones.schema["zones"].dataType)
        t = leaves.join(zones, ["gx", "gy"], "left").withColumn("zones", F.coalesce("zones", none))
        return t.select(cell_key(level, F.col("gx"), F.col("gy")).alias("_cell_key"),
                        ((F.col("gx").cast("double") + 1.0) * F.lit(s) + F.lit(self.x0)).alias("_right"),
                        (F.col("gy").cast("double") * F.lit(s) + F.lit(self.y0)).alias("_base"),
                        F.col("zones").alias("_zones"), self._sure_or_null().alias("_sure"))

    def _sure_or_null(self) -> Column:
        return F.when(F.size("zones") > 0, self._sure())

    def _locate(self, points: DataFrame, x: str, y: str, how: str) -> DataFrame:
        """Points beside the row of their leaf: one key a level, of which one is a leaf.

        Points outside the square keep a row of their own unless the join is inner.
        """
        tx, ty = F.col(x) - F.lit(self.x0), F.col(y) - F.lit(self.y0)
        square = F.lit(self.side)
        within = self._finite(x, y) & (tx >= 0) & (ty >= 0) & (tx < square) & (ty < square)
        keys = F.array(*[cell_key(k, F.floor(tx / F.lit(self._step(k))), F.floor(ty / F.lit(self._step(k)))) for k in self.levels])
        cells = self._join_side()
        pts = points.where(within).withColumn("_key", F.explode(keys))
        pts, side, salted = self._salted(pts, cells, points.columns)
        cond = pts["_key"] == side["_cell_key"]
        found = pts.join(side, cond if salted is None else cond & salted).select(*points.columns, "_right", "_base", "_zones", "_sure")
        if how == "inner":
            return found
        outside = points.where(~F.coalesce(within, F.lit(False)))
        return found.unionByName(outside, allowMissingColumns=True)


def zone_index(edges: DataFrame, *, attrs: Sequence[str] = ("zone_name",), broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
               **options) -> ZoneIndex:
    """The index that fits a layer: one grid where its cell table surely can be broadcast, else leaves of several sizes."""
    from blockwise.operators.spatial import _bbox_stats, choose_cell_size, entry_bound
    stats = _bbox_stats(edges)
    step = choose_cell_size(stats, broadcast_rows=broadcast_rows)
    if broadcast_rows is None or entry_bound(stats, step) <= broadcast_rows:
        return ZoneIndex(edges, attrs=attrs, stats=stats, broadcast_rows=broadcast_rows, **options)
    return QuadIndex(edges, attrs=attrs, broadcast_rows=broadcast_rows, **options)
