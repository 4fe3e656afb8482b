"""Street segments as searchable (street, borough, parity, range) rows.

A centerline row carries two sides (left/right house-number ranges) and two
street names.  ``segment_sides`` turns it into up to four rows in one narrow
``explode``; identical rows are removed inside the row with ``array_distinct``
first (both names equal), then over all rows (a centerline row that is repeated).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwise.functions.normalize import parity, parse_house_number

def _parse_bounds(segments: DataFrame, sides, names, borough: str, id_col: str,
                  mode: str) -> DataFrame:
    """Parse every bound once, in its own projection (names upper-cased once)."""
    cols = [F.col(id_col).alias("physical_id"), F.col(borough).cast("int").alias("_borough")]
    cols += [F.upper(F.col(n)).alias(f"_name_{i}") for i, n in enumerate(names)]
    for side, lo, hi in sides:
        cols += [parse_house_number(lo, mode).alias(f"_lo_{side}"),
                 parse_house_number(hi, mode).alias(f"_hi_{side}")]
    return segments.select(*cols)


def _side_struct(side: str, name_col: str, parity_of: str):
    lo, hi = F.col(f"_lo_{side}"), F.col(f"_hi_{side}")
    par_src = lo if parity_of == "low" else hi
    return F.struct(
        F.lit(side).alias("side"),
        F.col(name_col).alias("street"),
        F.col("_borough").alias("borough"),
        parity(par_src["number"]).alias("parity"),
        lo["block"].alias("low_block"), lo["number"].alias("low_number"),
        hi["block"].alias("high_block"), hi["number"].alias("high_number"),
    )


def segment_sides(segments: DataFrame, *, mode: str = "pair",
                  names: Sequence[str] = ("st_name", "full_street"),
                  sides: Sequence[tuple[str, str, str]] = (("L", "l_low", "l_high"),
                                                           ("R", "r_low", "r_high")),
                  borough: str = "borough", id_col: str = "physical_id",
                  parity_of: str = "low", dedup: bool = True) -> DataFrame:
    """U1 + U2 + A7: one row per (side, street name) of every segment.

    Parity of a side is that of its low number (``parity_of='high'`` for the
    high one).  A side whose bounds do not parse, or a null name, gives no
    row.  ``dedup=False`` keeps the double row of a segment whose two names
    are equal (plain U2).
    """
    parsed = _parse_bounds(segments, sides, names, borough, id_col, mode)
    rows = [_side_struct(s, f"_name_{i}", parity_of)
            for s, _, _ in sides for i, _ in enumerate(names)]
    arr = F.array(*rows)
    if dedup:
        arr = F.array_distinct(arr)
    valid = F.filter(arr, lambda r: r["street"].isNotNull() & r["low_number"].isNotNull()
                     & r["high_number"].isNotNull() & r["parity"].isNotNull())
    out = parsed.select("physical_id", F.explode(valid).alias("s")).select("physical_id", "s.*")
    return out.dropDuplicates() if dedup else out


def segment_sides_union(segments: DataFrame, *, mode: str = "pair", name: str = "st_name",
                        borough: str = "borough", id_col: str = "physical_id") -> DataFrame:
    """Left and right sides as two projections glued with ``unionByName``.

    The union form of ``segment_sides`` for a single name column; duplicates
    are kept (union all).
    """
    sides = (("L", "l_low", "l_high"), ("R", "r_low", "r_high"))
    parsed = _parse_bounds(segments, sides, (name,), borough, id_col, mode)
    parts = []
    for side, _, _ in sides:
        s = _side_struct(side, "_name_0", "low")
        parts.append(parsed.select("physical_id", s.alias("s"))
                     .select("physical_id", "s.*")
                     .where(F.col("low_number").isNotNull() & F.col("high_number").isNotNull()))
    return parts[0].unionByName(parts[1])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication (one shuffle on all columns)."""
    return df.dropDuplicates()
