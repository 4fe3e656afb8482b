"""The four end-to-end jobs, parameterised by input frames.

Each function takes already-read DataFrames (see ``blockwise.sources``) and
returns a lazy DataFrame; the caller decides on ``show``, ``collect`` or a
sink.  Nothing is collected inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwise.operators.keywords import keyword_filter, zone_rate
from blockwise.operators.range_join import (attribute_to_segments, count_columns,
                                            count_raw_records, normalize_addresses)
from blockwise.operators.ranking import format_topk_lines, nest_top_k, top_k
from blockwise.operators.segments import segment_sides
from blockwise.operators.spatial import ZoneIndex, weighted
from blockwise.operators.trend import add_slope


def segment_trend(records: DataFrame, segments: DataFrame, years: Sequence[int], *,
                  mode: str = "pair", keep: str = "matched", compare: str = "component",
                  null_policy: str = "zero_fill", record_cols: dict | None = None,
                  segment_cols: dict | None = None, county_map: dict | None = None,
                  bucket_width: int = 100,
                  broadcast_rows: int | None = None) -> DataFrame:
    """Job A: per street segment, records per year and the OLS slope.

    Records are counted per raw address first, normalised per distinct
    address, then attributed to segment sides (see ``range_join``).

    Output: physical_id, count_<year> for each year, ols_coeff (double).
    """
    rc = dict(record_cols or {})
    sc = dict(segment_cols or {})
    raw = count_raw_records(records, years, **rc)
    agg = normalize_addresses(raw, mode=mode, county_map=county_map)
    sides = segment_sides(segments, mode=mode, **sc)
    kw = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
    id_col = sc.get("id_col", "physical_id")
    counts = attribute_to_segments(
        agg, sides, count_cols=count_columns(years), keep=keep, compare=compare,
        segments=segments.select(F.col(id_col).alias("physical_id")).distinct(),
        bucket_width=bucket_width, **kw)
    return add_slope(counts, count_columns(years), years, null_policy=null_policy)


def zone_pair_top_k(trips: DataFrame, boroughs: ZoneIndex, neighborhoods: ZoneIndex, *,
                    pickup=("px", "py"), dropoff=("dx", "dy"), k: int = 3) -> DataFrame:
    """Job B: for each pickup borough, the k drop-off neighborhoods with most trips.

    Both lookups run on the same row, so no trip id is needed.
    Output: group_name, rank, zone_name, n (one row per kept pair).
    """
    return top_k(zone_pairs(trips, boroughs, neighborhoods, pickup=pickup, dropoff=dropoff), "group_name", k=k)


def zone_pairs(trips: DataFrame, boroughs: ZoneIndex, neighborhoods: ZoneIndex, *,
               pickup=("px", "py"), dropoff=("dx", "dy")) -> DataFrame:
    """Trips per pickup borough and drop-off neighborhood (an unnamed zone takes no part).

    In the shuffle form equal trips, then equal drop-offs of a borough, are counted before
    they are looked up.  Output: group_name, zone_name, n.
    """
    t = weighted(trips, [*pickup, *dropoff], (boroughs, neighborhoods), "_n")
    p = boroughs.assign(t, x=pickup[0], y=pickup[1], carry=("zone_name",), prefix="pu_", how="inner")
    p = p.where(F.col("pu_zone_name").isNotNull()).select("pu_zone_name", *dropoff, "_n")
    if not neighborhoods.is_broadcast:
        p = p.groupBy("pu_zone_name", *dropoff).agg(F.sum("_n").alias("_n"))
    d = neighborhoods.assign(p, x=dropoff[0], y=dropoff[1], carry=("zone_name",), prefix="do_", how="inner")
    return (d.where(F.col("do_zone_name").isNotNull())
            .groupBy(F.col("pu_zone_name").alias("group_name"), F.col("do_zone_name").alias("zone_name"))
            .agg(F.sum("_n").alias("n")))


def zone_pair_lines(trips: DataFrame, boroughs: ZoneIndex, neighborhoods: ZoneIndex,
                    **kw) -> DataFrame:
    """Job B as text lines ``borough,[('name', n), ...]`` in borough order."""
    ranked = zone_pair_top_k(trips, boroughs, neighborhoods, **kw)
    return format_topk_lines(nest_top_k(ranked, "group_name"), "group_name")


def keyword_rate(posts: DataFrame, zones: ZoneIndex, population: DataFrame,
                 terms: Sequence[str] | DataFrame, *, text: str = "text",
                 x: str = "x", y: str = "y") -> DataFrame:
    """Job C: posts containing a term, per zone, divided by zone population.

    The cheap token test runs before the spatial one.
    Output: zone_id, n, population, rate.
    """
    hits = keyword_filter(posts, text, terms)
    located = zones.assign(weighted(hits, [x, y], [zones], "_n"), x=x, y=y, how="inner")
    counts = located.groupBy("zone_id").agg(F.sum("_n").alias("n"))
    return zone_rate(counts, population)


def merge_zones(rates: DataFrame, zones: DataFrame, *, key: str = "tract") -> DataFrame:
    """Rates of zones that several features make up: counts summed by (``key``, population).

    ``rates`` as of ``keyword_rate``, ``zones`` with zone_id and ``key``.
    Output: ``key``, n, population, rate.
    """
    merged = (rates.join(zones.select("zone_id", key), "zone_id")
              .groupBy(key, "population").agg(F.sum("n").alias("n")))
    return merged.select(key, "n", "population", F.try_divide(
        F.col("n").cast("double"), F.col("population").cast("double")).alias("rate"))


def keyword_rate_lines(rates: DataFrame, *, key: str = "zone_id", value: str = "rate") -> DataFrame:
    """Job C as text lines ``key,rate`` in key order (K3 scalar form, O1).

    Numbers print as Spark casts them to text (``1.0E-4`` style for small
    values); a null rate (population 0) leaves the field empty.
    """
    line = F.concat(F.col(key).cast("string"), F.lit(","),
                    F.coalesce(F.col(value).cast("string"), F.lit("")))
    return rates.select(key, line.alias("line")).orderBy(key)


def zone_count(points: DataFrame, zones: ZoneIndex, *, x: str, y: str,
               carry: str = "zone_name") -> DataFrame:
    """Job D: points per zone (by zone name).  Output: zone_name, n."""
    located = zones.assign(weighted(points, [x, y], [zones], "_n"), x=x, y=y, carry=(carry,), how="inner")
    return located.groupBy(carry).agg(F.sum("_n").alias("n"))
