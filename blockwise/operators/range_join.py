"""Attribute records to street segments: equi-join plus house-number range.

Plan shape (segment trend):

1. ``count_raw_records`` pre-counts records by their raw address text with
   one count column per year.  Partial aggregation runs map-side, so even a
   street holding a third of all records shuffles one row per distinct
   address, not one row per record.
2. ``normalize_addresses`` parses and looks up each distinct address once.
3. ``attribute_to_segments`` joins those counts to segment sides on
   (street, borough, parity, dyadic node).  (block, number) is mapped to a
   position, in steps of ``bucket_width`` numbers; a side's range of positions
   is cut into its canonical dyadic intervals, two a level at most, and a
   record has one interval a level that holds its position.  The intervals of a
   range are disjoint, so a record meets a side at most once; the exact range
   test is the residual.  Ranges of any width, within a block or across blocks,
   take this one join, and a hot street is split by position.  The side table is
   written once to the shared folder; its size and its levels come from the
   write, and it is broadcast only if it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blockwise.functions.normalize import (code_lookup, parity, parse_house_number, year_any,
                                           year_from_text, year_lenient)
from blockwise.operators.sizing import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from blockwise.scratch import stored

KEEP_MODES = ("matched", "records", "segments")
COMPARE_MODES = ("component", "lexicographic")
KEYS = ("street", "borough", "parity")
RECORD_KEYS = (*KEYS, "block", "number")
SIDE_BOUNDS = ("low_block", "low_number", "high_block", "high_number")
#: Bits of a position that tell the numbers of a block apart (numbers beyond them share the last bucket).
NUMBER_BITS = 16


def record_year(date: str, date_format: str | Sequence[str] | None = None) -> Column:
    """Year of date text: of any usual shape (default), in one format, or in the first of several that parses."""
    if date_format is None:
        return year_any(date)
    if isinstance(date_format, str):
        return year_from_text(F.col(date), date_format)
    return year_lenient(F.col(date), date_format)


def count_bad_dates(df: DataFrame, date: str,
                    date_format: str | Sequence[str] | None = None) -> DataFrame:
    """One row: n records, n_bad whose date text does not parse (null text counts)."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(record_year(date, date_format).isNull()).alias("n_bad"))


def prepare_records(df: DataFrame, years: Sequence[int], *, mode: str = "pair",
                    street: str = "street_name", county: str = "county",
                    house: str = "house_no", year: str | None = "issue_year",
                    date: str | None = None, date_format: str | Sequence[str] | None = None,
                    county_map: dict | None = None) -> DataFrame:
    """Clean raw records to (street, borough, parity, block, number, year).

    Rows with a null field, an unknown county, a year outside ``years`` or a
    malformed house number are dropped (F1, F2, F4, F5, F7).  The year comes
    from an int column ``year`` or from date text ``date``.
    """
    hn = parse_house_number(house, mode)
    yr = F.col(year).cast("int") if date is None else record_year(date, date_format)
    out = df.select(
        F.upper(F.col(street)).alias("street"),
        code_lookup(F.col(county), county_map).cast("int").alias("borough"),
        hn["block"].alias("block"), hn["number"].alias("number"),
        yr.alias("year"),
    ).withColumn("parity", parity(F.col("number")))
    lo, hi = min(years), max(years)
    return (out.where(F.col("street").isNotNull() & F.col("borough").isNotNull()
                      & F.col("number").isNotNull() & F.col("year").between(lo, hi))
            .select(*RECORD_KEYS, "year"))


def count_raw_records(df: DataFrame, years: Sequence[int], *, street: str = "street_name",
                      county: str = "county", house: str = "house_no",
                      year: str | None = "issue_year", date: str | None = None,
                      date_format: str | Sequence[str] | None = None) -> DataFrame:
    """Pre-aggregate raw records by their raw address text, one count per year.

    Runs before any text normalisation: partial aggregation map-side cuts
    records to distinct (street, county, house text) keys, so the regex and
    lookup work of ``normalize_addresses`` runs once per distinct address,
    not once per record.  A hot street costs one row per distinct address.
    """
    yr = F.col(year).cast("int") if date is None else record_year(date, date_format)
    lo, hi = min(years), max(years)
    keyed = df.select(F.col(street).alias("street_raw"), F.col(county).alias("county_raw"),
                      F.col(house).alias("house_raw"), yr.alias("year"))
    keyed = keyed.where(F.col("year").between(lo, hi))
    aggs = [F.count_if(F.col("year") == F.lit(y)).alias(c)
            for y, c in zip(years, count_columns(years))]
    return keyed.groupBy("street_raw", "county_raw", "house_raw").agg(*aggs)


def normalize_addresses(raw_counts: DataFrame, *, mode: str = "pair",
                        county_map: dict | None = None) -> DataFrame:
    """Raw address keys -> (street, borough, parity, block, number) + counts.

    Keys that do not normalise (null street, unknown county, malformed house
    number) are dropped.
    """
    counts = [c for c in raw_counts.columns if c.startswith("count_")]
    key = F.struct(F.upper(F.col("street_raw")).alias("street"),
                   code_lookup(F.col("county_raw"), county_map).cast("int").alias("borough"),
                   parse_house_number("house_raw", mode).alias("hn"))
    # The key is built once per row inside a one-element array and invalid
    # keys drop out of the explode.  A plain filter would be pushed below the
    # aggregate by the optimizer and re-run the parse once per raw record.
    valid = F.filter(F.array(key), lambda k: k["street"].isNotNull()
                     & k["borough"].isNotNull() & k["hn"].isNotNull())
    out = raw_counts.select(F.explode(valid).alias("k"), *counts)
    return out.select(F.col("k.street").alias("street"), F.col("k.borough").alias("borough"),
                      parity(F.col("k.hn.number")).alias("parity"),
                      F.col("k.hn.block").alias("block"), F.col("k.hn.number").alias("number"),
                      *counts)


def count_columns(years: Sequence[int]) -> list[str]:
    return [f"count_{y}" for y in years]


def _range_condition(r: str, s: str, compare: str) -> Column:
    rb, rn = F.col(f"{r}.block"), F.col(f"{r}.number")
    if compare == "component":
        return (rb.between(F.col(f"{s}.low_block"), F.col(f"{s}.high_block"))
                & rn.between(F.col(f"{s}.low_number"), F.col(f"{s}.high_number")))
    key = F.struct(rb.alias("b"), rn.alias("n"))
    lo = F.struct(F.col(f"{s}.low_block").alias("b"), F.col(f"{s}.low_number").alias("n"))
    hi = F.struct(F.col(f"{s}.high_block").alias("b"), F.col(f"{s}.high_number").alias("n"))
    return (key >= lo) & (key <= hi)


def _equi(r: str, s: str, cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        e = F.col(f"{r}.{c}") == F.col(f"{s}.{c}")
        cond = e if cond is None else cond & e
    return cond


def position(block: Column, number: Column, bucket_width: int) -> Column:
    """A long that never decreases with (block, number): ``bucket_width`` numbers of a block share one."""
    bucket = F.least(F.floor(number / F.lit(bucket_width)), F.lit((1 << NUMBER_BITS) - 1).cast("long"))
    return F.shiftleft(F.coalesce(block, F.lit(0)).cast("long"), NUMBER_BITS) + bucket


def dyadic_cover(lo: str, hi: str) -> Column:
    """The canonical dyadic intervals of [lo, hi], as (level, node): node * 2^level up to the next node.

    They are disjoint and cover the range; a level has two at most, and a range of n positions
    has levels up to log2(n).  Empty if lo > hi.
    """
    first = f"shiftright({lo} + shiftleft(1L, _l) - 1, _l)"    # the first whole interval of the level
    end = f"shiftright({hi} + 1, _l)"                          # after the last one
    left = f"named_struct('level', _l, 'node', CASE WHEN {first} < {end} AND {first} % 2 = 1 THEN {first} END)"
    right = f"named_struct('level', _l, 'node', CASE WHEN {first} < {end} AND {end} % 2 = 1 THEN {end} - 1 END)"
    levels = f"sequence(0, CAST(floor(log2({hi} - {lo} + 1)) AS INT) + 1)"
    return F.expr(f"CASE WHEN {lo} <= {hi} THEN filter(flatten(transform({levels}, _l -> array({left}, {right}))), _n -> _n.node IS NOT NULL) END")


def _valid_sides(sides: DataFrame) -> DataFrame:
    # A segment without an id cannot be reported (its counts would merge
    # into the null row of unmatched records).
    return sides.where(F.col("physical_id").isNotNull() & F.col("street").isNotNull()
                       & F.col("low_number").isNotNull() & F.col("high_number").isNotNull())


def side_table(sides: DataFrame, bucket_width: int = 100) -> tuple[DataFrame, int, list[int]]:
    """Sides by their dyadic intervals, stored once; its rows and its levels, observed by the write."""
    base = _valid_sides(sides)
    base = base.withColumn("_lo", position(F.col("low_block"), F.col("low_number"), bucket_width)) \
               .withColumn("_hi", position(F.col("high_block"), F.col("high_number"), bucket_width))
    nodes = base.select("physical_id", *KEYS, *SIDE_BOUNDS, F.explode(dyadic_cover("_lo", "_hi")).alias("_n"))
    nodes = nodes.select("physical_id", *KEYS, *SIDE_BOUNDS, F.col("_n.level").alias("level"), F.col("_n.node").alias("node"))
    seen = Observation()
    kept = stored(nodes.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_or(F.expr("shiftleft(1L, level)")).alias("levels")), "sides")
    levels = seen.get["levels"] or 1
    return kept, int(seen.get["n"] or 0), [k for k in range(63) if levels >> k & 1]


def attribute_to_segments(records_agg: DataFrame, sides: DataFrame, *,
                          count_cols: Sequence[str], keep: str = "matched",
                          compare: str = "component", segments: DataFrame | None = None,
                          bucket_width: int = 100,
                          broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                          broadcast: bool | None = None) -> DataFrame:
    """Per-segment sums of the record counts.

    keep ``matched``   segments with at least one record (inner join, J2)
    keep ``records``   matched segments plus one row with a null id holding
                       the counts of records that match no segment (J1)
    keep ``segments``  every segment of ``segments`` (default: of ``sides``),
                       counts null where nothing matched (J3)

    Output: ``physical_id`` and ``count_cols`` (bigint sums).
    """
    if keep not in KEEP_MODES:
        raise ValueError(f"keep must be one of {KEEP_MODES}")
    if compare not in COMPARE_MODES:
        raise ValueError(f"compare must be one of {COMPARE_MODES}")
    table, n_rows, levels = side_table(sides, bucket_width)
    if broadcast is None:
        broadcast = broadcast_rows is not None and n_rows <= broadcast_rows
    side, is_bc = maybe_broadcast(table, None, broadcast)

    at = position(F.col("block"), F.col("number"), bucket_width)
    nodes = [F.struct(F.lit(k).alias("level"), F.shiftright(at, k).alias("node")) for k in levels]
    placed = records_agg.withColumn("_n", nodes[0] if len(nodes) == 1 else F.explode(F.array(*nodes)))
    r = placed.select("*", F.col("_n.level").alias("level"), F.col("_n.node").alias("node")).alias("r")
    cond = _equi("r", "s", (*KEYS, "level", "node")) & _range_condition("r", "s", compare)
    pick = [F.col("s.physical_id").alias("physical_id")] + [F.col(f"r.{c}") for c in count_cols]
    sums = [F.sum(c).cast("bigint").alias(c) for c in count_cols]
    if keep == "records" and len(levels) == 1:
        # One left join: unmatched house-number keys land in the null group.
        return r.join(side.alias("s"), cond, "left").select(*pick) \
                .groupBy("physical_id").agg(*sums)
    hits = r.join(side.alias("s"), cond, "inner")
    matched = hits.select(*pick).groupBy("physical_id").agg(*sums)
    if keep == "matched":
        return matched
    if keep == "records":
        # A record has a row a level here, so those without any segment are found by address.
        found = hits.select(*[F.col(f"r.{c}").alias(c) for c in RECORD_KEYS]).distinct().alias("f")
        same = F.lit(True)
        for c in RECORD_KEYS:
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"f.{c}"))
        miss = records_agg.alias("a").join(found, same, "left_anti")
        unmatched = (miss.agg(*sums)
                     .where(F.col(count_cols[0]).isNotNull())   # no row when all matched
                     .select(F.lit(None).cast(matched.schema["physical_id"].dataType)
                             .alias("physical_id"), *count_cols))
        return matched.unionByName(unmatched)
    seg_ids = ((segments if segments is not None else sides).select("physical_id")
               .where(F.col("physical_id").isNotNull()).distinct())
    # ``matched`` has at most one row per segment id, so it is no larger than
    # the segment list whose size the broadcast check above already bounded.
    m = F.broadcast(matched) if is_bc else matched
    return seg_ids.join(m, "physical_id", "left")
