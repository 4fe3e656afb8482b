"""Driver query catalogue: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through ``blockwise.sources.tables``
(the recipes grow with the base tables) and aliases every computed column to
the name its DuckDB oracle (``blockwise.plans.oracle``) uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockwise.functions import normalize as N
from blockwise.functions.geometry import project_lcc
from blockwise.operators import keywords as K
from blockwise.operators import ranking as R
from blockwise.operators import segments as S
from blockwise.operators import trend as T
from blockwise.operators.cleaning import drop_incomplete, fill_zero, reject_reason, split_rejects
from blockwise.operators.range_join import count_bad_dates, count_columns, prepare_records
from blockwise.operators.quadtree import QuadIndex
from blockwise.operators.spatial import ZoneIndex
from blockwise.plans import jobs
from blockwise.sources import tables as TB

YEARS = N.year_window(TB.RECORD_FIRST_YEAR)          # 1996 .. 2000
COUNTS = count_columns(YEARS)
TERMS = ("the", "of")                                 # keyword list of the catalogue

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --------------------------------------------------------------------------
# Job A: segment trend and its parts
# --------------------------------------------------------------------------

def _trend(spark, sf, **kw) -> DataFrame:
    return jobs.segment_trend(TB.records(spark, sf), TB.segments(spark, sf), YEARS, **kw)


@query("segment_trend")
def segment_trend(spark, sf):
    """Flagship: block/number pairs, component ranges, matched segments."""
    return _trend(spark, sf, mode="pair", keep="matched")


@query("segment_trend_dup")
def segment_trend_dup(spark, sf):
    """A7 inside job A: a third of the centerline rows repeated; counts stay single."""
    s = TB.segments(spark, sf)
    return jobs.segment_trend(TB.records(spark, sf), s.unionByName(s.where("physical_id % 3 = 0")), YEARS)


@query("segment_trend_dated")
def segment_trend_dated(spark, sf):
    """P7 inside job A: years from date text of several shapes."""
    r = TB.records(spark, sf).join(TB.records_dated(spark, sf), "record_id")
    return jobs.segment_trend(r, TB.segments(spark, sf), YEARS,
                              record_cols={"date": "issue_date", "year": None})


@query("bad_dates")
def bad_dates(spark, sf):
    """records whose date text does not parse."""
    return count_bad_dates(TB.records_dated(spark, sf), "issue_date")


@query("keyword_long_list")
def keyword_long_list(spark, sf):
    """J6 with a word list taken from a table column (over 10,000 entries at scale), by join."""
    posts = TB.table(spark, sf, "documents").select("doc_id", "text")
    names = TB.table(spark, sf, "customer").select(F.col("c_name").alias("value"))
    words = TB.table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("value"))
    return K.keyword_filter(posts, "text", K.union_terms(names, words), max_bytes=0).select("doc_id")


@query("range_join_keep_records")
def range_join_keep_records(spark, sf):
    """Parts glued as integers, unmatched records kept as a null segment."""
    return _trend(spark, sf, mode="concat_int", keep="records")


@query("range_join_keep_segments")
def range_join_keep_segments(spark, sf):
    """Text-concatenated numbers, every segment kept, slope 0.0 when a count is null."""
    return _trend(spark, sf, mode="concat_text", keep="segments", null_policy="zero_slope")


@query("range_join_split")
def range_join_split(spark, sf):
    """(block, number) pairs compared lexicographically, matched only."""
    return _trend(spark, sf, mode="pair", keep="matched", compare="lexicographic")


# --------------------------------------------------------------------------
# Column operators on records
# --------------------------------------------------------------------------

@query("proj_prune")
def proj_prune(spark, sf):
    """Prune, rename, drop a column that is already gone (no-op)."""
    r = TB.records(spark, sf)
    return (r.select("record_id", F.col("street_name").alias("street"), "house_no")
            .drop("issue_date"))


@query("str_normalize")
def str_normalize(spark, sf):
    """Upper-case a name column (part names are lower-case words)."""
    p = TB.table(spark, sf, "part").select("p_partkey", "p_name")
    return p.select(F.col("p_partkey").alias("physical_id"), N.upper("p_name").alias("street"))


@query("map_code_lookup")
def map_code_lookup(spark, sf):
    """P5: county code -> borough id; unknown codes give null."""
    r = TB.records(spark, sf)
    return r.select("record_id", "county", N.code_lookup("county").alias("borough"))


@query("date_year")
def date_year(spark, sf):
    """Year from date text (fixed format, lenient) and window test."""
    d = TB.records_dated(spark, sf)
    strict = N.year_from_text("issue_date")
    return d.select("record_id", "issue_date", strict.alias("year_strict"),
                    N.year_lenient("issue_date", ("M/d/yyyy", "yyyy-MM-dd")).alias("year_lenient"),
                    strict.between(min(YEARS), max(YEARS)).alias("in_window"))


#: Shapes of date text that ``date_shapes`` writes the orders' dates in (Java patterns).
DATE_SHAPES = ("M/d/yyyy", "yyyy-MM-dd'T'HH:mm", "d MMM yyyy", "MMMM d, yyyy", "M/d/yyyy h:mm a", "yyyyMMdd", "EEE, d MMMM yyyy HH:mm:ss", "MM/dd/yy")


@query("date_shapes")
def date_shapes(spark, sf):
    """Year, month and day of dates written in eight shapes, one an order."""
    o = TB.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    text = F.element_at(F.array(*[F.date_format("t", p) for p in DATE_SHAPES]), (F.col("o_orderkey") % len(DATE_SHAPES) + 1).cast("int"))
    d = o.select(F.col("o_orderkey").alias("record_id"), text.alias("issue_date"))
    return d.select("record_id", "issue_date", N.date_fields("issue_date").alias("f")).select("record_id", "issue_date", "f.*")


@query("safe_cast")
def safe_cast(spark, sf):
    """Text -> int / double, null when it does not parse."""
    r = TB.records(spark, sf)
    return r.select("record_id", N.safe_int("house_no").alias("house_int"),
                    N.safe_double("house_no").alias("house_double"))


def _house(spark, sf, mode):
    r = TB.records(spark, sf)
    h = N.parse_house_number("house_no", mode)
    return r.select("record_id", "house_no", h["block"].alias("block"), h["number"].alias("number"))


@query("house_concat_text")
def house_concat_text(spark, sf):
    """Separators removed as text (12-05 -> 1205)."""
    return _house(spark, sf, "concat_text")


@query("house_concat_int")
def house_concat_int(spark, sf):
    """Parts parsed then glued (12-05 -> 125)."""
    return _house(spark, sf, "concat_int")


@query("house_split")
def house_split(spark, sf):
    """P10: (block, number) pair (12-05 -> (12, 5))."""
    return _house(spark, sf, "pair")


@query("parity_label")
def parity_label(spark, sf):
    """Parity of the house number; null when it does not parse."""
    h = _house(spark, sf, "pair")
    return h.select("record_id", "number", N.parity("number").alias("parity"))


@query("onehot_year")
def onehot_year(spark, sf):
    """One 0/1 column per year of the window; other years dropped."""
    r = TB.records(spark, sf).where(F.col("issue_year").between(min(YEARS), max(YEARS)))
    return r.select("record_id", *N.year_onehot("issue_year", YEARS))


def _prepared(spark, sf, mode="concat_text"):
    return prepare_records(TB.records(spark, sf), YEARS, mode=mode)


@query("seg_year_counts")
def seg_year_counts(spark, sf):
    """A3/A4: conditional counts per (street, borough, parity) and year."""
    return T.yearly_counts(_prepared(spark, sf), ["street", "borough", "parity"], "year", YEARS)


@query("count_all_cols")
def count_all_cols(spark, sf):
    """A5: multiplicity of identical cleaned records."""
    return T.count_all_columns(_prepared(spark, sf))


@query("pivot_year")
def pivot_year(spark, sf):
    """A5 then A6: count identical records, pivot years with max."""
    counted = T.count_all_columns(_prepared(spark, sf))
    return T.pivot_years(counted, ["street", "borough", "parity", "block", "number"],
                         "year", "n", YEARS)


@query("slope_wide")
def slope_wide(spark, sf):
    """Closed-form slope over wide yearly counts per street."""
    c = T.yearly_counts(_prepared(spark, sf), ["street", "borough"], "year", YEARS)
    return T.add_slope(c, COUNTS, YEARS).select("street", "borough", "ols_coeff")


@query("slope_long")
def slope_long(spark, sf):
    """regr_slope over long (street, year, n) rows, rounded to 6 places."""
    c = T.yearly_counts(_prepared(spark, sf), ["street"], "year", YEARS)
    long = T.to_long(c, "street", COUNTS, YEARS)
    s = T.slope_long(long, "street")
    # ``+ 0.0`` turns a -0.0 from regr_slope into 0.0.
    return s.select("street", (F.round("ols_coeff", 6) + F.lit(0.0)).alias("ols_coeff"))


@query("dropna_any")
def dropna_any(spark, sf):
    """records with every used field present."""
    r = TB.records(spark, sf)
    return drop_incomplete(r, ["house_no", "street_name", "county"]).select("record_id", "house_no")


@query("fillna_zero")
def fillna_zero(spark, sf):
    """every segment with its counts, nulls filled with 0 (id untouched)."""
    c = _trend(spark, sf, mode="concat_text", keep="segments", null_policy="null")
    return fill_zero(c.select("physical_id", *COUNTS), COUNTS)


@query("reject_split")
def reject_split(spark, sf):
    """clean vs. rejected records (bad house number or unknown county)."""
    r = TB.records(spark, sf)
    valid = N.parse_house_number("house_no", "pair").isNotNull() & \
        N.code_lookup("county").isNotNull()
    flagged = split_rejects(r, valid)
    return flagged.groupBy("rejected").agg(F.count(F.lit(1)).alias("n"))


@query("reject_reasons")
def reject_reasons(spark, sf):
    """every record that a job would drop, with the first rule it breaks."""
    reason = reject_reason({"street": F.col("street_name").isNotNull(), "county": N.code_lookup("county").isNotNull(),
                            "house": N.parse_house_number("house_no", "pair").isNotNull()})
    return TB.records(spark, sf).select("record_id", reason.alias("reason")).where("reason IS NOT NULL")


# --------------------------------------------------------------------------
# Segment fan-out
# --------------------------------------------------------------------------

@query("segment_sides")
def segment_sides_q(spark, sf):
    """Left and right sides by union; parity from each side's low number."""
    s = S.segment_sides_union(TB.segments(spark, sf), mode="pair")
    return s.select("physical_id", "side", "street", "borough", "parity",
                    "low_number", "high_number")


@query("segment_alias_explode")
def segment_alias_explode(spark, sf):
    """1 -> 4 rows per segment (side x street name), duplicates kept."""
    s = S.segment_sides(TB.segments(spark, sf), mode="pair", dedup=False)
    return s.select("physical_id", "side", "street", "parity", "low_number", "high_number")


@query("dedup_rows")
def dedup_rows(spark, sf):
    """Whole-row de-duplication of the exploded sides."""
    s = S.segment_sides(TB.segments(spark, sf), mode="pair", dedup=False)
    return S.dedup_rows(s.select("physical_id", "side", "street", "parity",
                                 "low_number", "high_number"))


# --------------------------------------------------------------------------
# Spatial (J4, J5, J7, F8, A2, K5, P16) and job D
# --------------------------------------------------------------------------

def neighborhoods(spark, sf) -> ZoneIndex:
    return ZoneIndex(TB.neighborhood_edges(spark, sf), attrs=("zone_name",))


def boroughs(spark, sf) -> ZoneIndex:
    return ZoneIndex(TB.borough_edges(spark, sf), attrs=("zone_name",))


def both_layers(spark, sf) -> tuple[ZoneIndex, ZoneIndex]:
    """Borough and neighborhood indexes, statistics from one job."""
    ix = ZoneIndex.build_many({"boroughs": TB.borough_edges(spark, sf),
                               "neighborhoods": TB.neighborhood_edges(spark, sf)},
                              attrs=("zone_name",))
    return ix["boroughs"], ix["neighborhoods"]


@query("pip_assign")
def pip_assign(spark, sf):
    """Every trip's pickup neighborhood (null outside all zones)."""
    t = TB.trips(spark, sf).select("trip_id", "px", "py")
    a = neighborhoods(spark, sf).assign(t, x="px", y="py", carry=("zone_name",))
    return a.select("trip_id", "zone_id", "zone_name")


@query("pip_zone_count")
def pip_zone_count(spark, sf):
    """Job D / K5: pickups per borough."""
    return jobs.zone_count(TB.trips(spark, sf), boroughs(spark, sf), x="px", y="py")


@query("pip_pair_count")
def pip_pair_count(spark, sf):
    """Trips per (pickup borough, drop-off neighborhood)."""
    return jobs.zone_pairs(TB.trips(spark, sf), *both_layers(spark, sf))


@query("zone_count_apart")
def zone_count_apart(spark, sf):
    """Job D where the cell table is joined by a shuffle: each exact coordinate is counted first."""
    apart = ZoneIndex(TB.borough_edges(spark, sf), attrs=("zone_name",), broadcast=False)
    return jobs.zone_count(TB.trips(spark, sf), apart, x="px", y="py")


@query("mixed_layer_count")
def mixed_layer_count(spark, sf):
    """J4/J5 over one layer of big and small polygons: pickups per zone, in every zone that holds them."""
    n, b = TB.neighborhood_edges(spark, sf), TB.borough_edges(spark, sf)
    layer = n.unionByName(b.withColumn("zone_id", F.col("zone_id") + 1000))
    t = TB.trips(spark, sf).select("px", "py")
    found = QuadIndex(layer, attrs=("zone_name",)).assign(t, x="px", y="py", carry=("zone_name",), how="inner", match="all")
    return found.groupBy("zone_id", "zone_name").agg(F.count(F.lit(1)).alias("n"))


# Trip points read as degrees around the projection's origin.
LON0, LAT0, DEG_PER_UNIT = -74.25, 40.5, 0.1


@query("project_lcc")
def project_lcc_q(spark, sf):
    """lon/lat -> EPSG:2263 feet (Lambert conformal conic), rounded to mm."""
    t = TB.trips(spark, sf).select(
        "trip_id", (F.lit(LON0) + F.col("px") * F.lit(DEG_PER_UNIT)).alias("lon"),
        (F.lit(LAT0) + F.col("py") * F.lit(DEG_PER_UNIT)).alias("lat"))
    x, y = project_lcc("lon", "lat")
    return t.select("trip_id", F.round(x, 3).alias("x_ft"), F.round(y, 3).alias("y_ft"))


# --------------------------------------------------------------------------
# Keywords (P15, J6, U3, F9, P18) and job C
# --------------------------------------------------------------------------

@query("keyword_filter")
def keyword_filter(spark, sf):
    """Posts whose whole text has a term among its space-split tokens."""
    return K.keyword_filter(TB.posts(spark, sf), "text", TERMS).select("post_id")


@query("keyword_semi_join")
def keyword_semi_join(spark, sf):
    """J6 as explode + broadcast semi-join + distinct; word lists concatenated."""
    terms = K.union_terms(*[spark.range(1).select(F.lit(t).alias("value")) for t in TERMS])
    return K.keyword_semi_join(TB.posts(spark, sf), "text", terms, keep=["post_id", "x", "y"])


@query("keyword_zone_count")
def keyword_zone_count(spark, sf):
    """matching posts per neighborhood (every zone id, 0 included)."""
    hits = K.keyword_filter(TB.posts(spark, sf), "text", TERMS)
    z = neighborhoods(spark, sf).assign(hits.select("x", "y"), x="x", y="y", how="inner")
    return z.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"))


@query("zone_rate")
def zone_rate(spark, sf):
    """Job C / P18: matching posts per neighborhood divided by its population."""
    return jobs.keyword_rate(TB.posts(spark, sf), neighborhoods(spark, sf),
                             TB.zone_population(spark, sf), TERMS)


# --------------------------------------------------------------------------
# Ranking (W1, A8-A10, U4, U5, K3) and job B
# --------------------------------------------------------------------------

def _ranked(spark, sf):
    return jobs.zone_pair_top_k(TB.trips(spark, sf), *both_layers(spark, sf), k=3)


@query("topk_per_group")
def topk_per_group(spark, sf):
    """The 3 drop-off neighborhoods with most trips per pickup borough."""
    return _ranked(spark, sf).select("group_name", "rank", "zone_name", "n")


@query("topk_salted")
def topk_salted(spark, sf):
    """The 5 largest orders of each priority, ranked within salts first."""
    o = TB.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    ranked = R.top_k(o, "o_orderpriority", k=5, order=[F.col("cents").desc(), F.col("o_orderkey").asc()], salts=16)
    return ranked.select("o_orderpriority", "rank", "o_orderkey", "cents")


@query("topk_nested")
def topk_nested(spark, sf):
    """The ranked lists nested per borough (shown as joined text)."""
    nested = R.nest_top_k(_ranked(spark, sf), "group_name")
    return nested.select(
        "group_name",
        F.array_join(F.transform("top", lambda s: s["zone_name"]), "|").alias("names"),
        F.array_join(F.transform("top", lambda s: s["n"].cast("string")), "|").alias("counts"))


@query("fmt_topk_line")
def fmt_topk_line(spark, sf):
    """Job B / K3: ``borough,[('name', n), ...]`` lines in borough order."""
    return jobs.zone_pair_lines(TB.trips(spark, sf), *both_layers(spark, sf))


# --------------------------------------------------------------------------
# Sums, sorts, limits (A1, O1-O3, K4)
# --------------------------------------------------------------------------

@query("sum_by_key")
def sum_by_key(spark, sf):
    """A1: order value in cents summed per priority."""
    o = TB.table(spark, sf, "orders").select("o_orderpriority", "o_totalprice")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.groupBy("o_orderpriority").agg(F.sum(cents).alias("total_cents"))


@query("sort_by_key")
def sort_by_key(spark, sf):
    """O1/O2: global sort of the records by (year, id) (range-partitioned)."""
    r = TB.records(spark, sf).select("record_id", "issue_year")
    return r.orderBy("issue_year", "record_id")


@query("limit_sorted")
def limit_sorted(spark, sf):
    """K4/O3: the 10 most valuable orders (TakeOrderedAndProject)."""
    o = TB.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.limit_sorted(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)
