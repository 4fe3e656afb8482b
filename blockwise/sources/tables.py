"""The driver's parquet tables and the job inputs derived from them.

The raw inputs of the four jobs (violations, centerline, trips, tweets,
polygon layers) are not available, so each is derived from the driver's
TPC-H-like tables by a fixed recipe.  Every derived frame grows with its base
table: records/trips from ``orders``, segments from ``part``, posts from
``documents``, zones from ``nation``/``region``, population from ``customer``.
Only the columns a recipe needs are selected, so the parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# ---------------------------------------------------------------------------
# Fixed values of the recipes.
# Pentagon used for every zone: one row per edge, offsets (dx, dy) of the
# start vertex and (ex, ey) of the end vertex from the zone centre.
PENTAGON = (
    (0.4871, 0.0313, 0.0317, 0.4783),
    (0.0317, 0.4783, -0.4679, -0.0171),
    (-0.4679, -0.0171, -0.1037, -0.1191),
    (-0.1037, -0.1191, 0.0271, -0.4611),
    (0.0271, -0.4611, 0.4871, 0.0313),
)
# Coordinates are (k * multiplier mod 1000) / 200, i.e. a 0.005 grid on [0, 5).
TRIP_MULTIPLIERS = {"px": 37, "py": 53, "dx": 71, "dy": 29}
POST_MULTIPLIERS = {"x": 37, "y": 53}
# First year of the five-year window covered by the orders table.
RECORD_FIRST_YEAR = 1996
# ---------------------------------------------------------------------------


# Column types of the driver's tables that the recipes read.
# Declaring them spares the schema-inference job Spark runs on every read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (lazy; columns pruned by the consumer)."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _st(c) -> F.Column:
    return F.concat(F.lit("ST "), c.cast("string"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parking-violation-like records: one per order.

    Columns: record_id, street_name, county (code text, some unknown),
    house_no (text with every malformed shape), issue_year (int).
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    county = (F.when(c % 7 == 6, "ZZ").when(c % 5 == 0, "NY").when(c % 5 == 1, "BX")
              .when(c % 5 == 2, "K").when(c % 5 == 3, "QN").otherwise("R"))
    kind = k % 10
    house = (F.when(kind == 0, F.lit(None).cast("string"))
             .when(kind == 1, F.lit("NA"))
             .when(kind == 2, F.concat((k % 97).cast("string"), F.lit("A")))
             .when(kind == 3, F.concat((1 + k % 4).cast("string"), F.lit("-"),
                                       F.right(F.concat(F.lit("0"), (c % 90).cast("string")),
                                               F.lit(2))))
             .when(kind == 4, F.concat((1 + k % 4).cast("string"), F.lit(" "),
                                       (10 + c % 80).cast("string")))
             .otherwise((1 + c % 400).cast("string")))
    return o.select(k.alias("record_id"), _st(c % 40).alias("street_name"),
                    county.alias("county"), house.alias("house_no"),
                    F.year("o_orderdate").alias("issue_year"))


def records_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the issue date as text (``M/d/yyyy`` and bad variants)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    mdy = F.concat_ws("/", F.month(d).cast("string"), F.dayofmonth(d).cast("string"),
                      F.year(d).cast("string"))
    padded = F.concat_ws("/", F.lpad(F.month(d).cast("string"), 2, "0"),
                         F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.year(d).cast("string"))
    iso = F.concat_ws("-", F.year(d).cast("string"), F.lpad(F.month(d).cast("string"), 2, "0"),
                      F.lpad(F.dayofmonth(d).cast("string"), 2, "0"))
    kind = k % 8
    text = (F.when(kind == 0, F.lit("13/45/2017")).when(kind == 1, F.lit(""))
            .when(kind == 2, F.year(d).cast("string")).when(kind == 3, padded)
            .when(kind == 4, iso).otherwise(mdy))
    return o.select(k.alias("record_id"), text.alias("issue_date"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street-centerline-like segments: one per part.

    Columns: physical_id, st_name, full_street, borough, l_low, l_high,
    r_low, r_high (left side odd numbers, right side even).
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k, size = F.col("p_partkey"), F.col("p_size")
    base = 2 * (k % 60)
    full = F.when(k % 3 == 0, _st(k % 40)).otherwise(_st((k + 5) % 40))
    return p.select(k.alias("physical_id"), _st(k % 40).alias("st_name"),
                    full.alias("full_street"), (1 + (k % 5).cast("int")).alias("borough"),
                    (1 + base).alias("l_low"), (1 + base + 2 * size).alias("l_high"),
                    (2 + base).alias("r_low"), (2 + base + 2 * size).alias("r_high"))


def zone_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighborhood layer: one pentagon per nation, one row per edge.

    Columns: zone_id, zone_name, group_id, group_name, x1, y1, x2, y2.
    A borough (``group_*``) is the multipolygon of its region's nations.
    """
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # The region table is the size of the region list (5 rows in TPC-H); the
    # planner broadcasts it by its own size estimate.
    z = n.join(r, n.n_regionkey == r.r_regionkey)
    shape = F.explode(F.array(*[
        F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("ex"),
                 F.lit(d).alias("ey")) for a, b, c, d in PENTAGON])).alias("o")
    cx = (F.col("n_nationkey") % 5).cast("double") + F.lit(0.5)
    cy = F.floor(F.col("n_nationkey") / 5).cast("double") + F.lit(0.5)
    return (z.select("n_nationkey", "n_name", "n_regionkey", "r_name", shape)
            .select(F.col("n_nationkey").cast("long").alias("zone_id"),
                    F.col("n_name").alias("zone_name"),
                    F.col("n_regionkey").cast("long").alias("group_id"),
                    F.col("r_name").alias("group_name"),
                    (cx + F.col("o.dx")).alias("x1"), (cy + F.col("o.dy")).alias("y1"),
                    (cx + F.col("o.ex")).alias("x2"), (cy + F.col("o.ey")).alias("y2")))


def borough_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borough layer: the region multipolygons (zone_id = region key)."""
    e = zone_edges(spark, sf_dir)
    return e.select(F.col("group_id").alias("zone_id"), F.col("group_name").alias("zone_name"),
                    "x1", "y1", "x2", "y2")


def neighborhood_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighborhood layer: the nation pentagons."""
    return zone_edges(spark, sf_dir).select("zone_id", "zone_name", "x1", "y1", "x2", "y2")


def _grid(c, mult: int) -> F.Column:
    return (c * mult % 1000).cast("double") / F.lit(200.0)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi-trip-like points: trip_id, pickup (px, py), drop-off (dx, dy)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m = TRIP_MULTIPLIERS
    return o.select(k.alias("trip_id"), _grid(k, m["px"]).alias("px"), _grid(c, m["py"]).alias("py"),
                    _grid(k, m["dx"]).alias("dx"), _grid(c, m["dy"]).alias("dy"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweet-like posts: post_id, text (whole document), point (x, y)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    m = POST_MULTIPLIERS
    return d.select(k.alias("post_id"), "text", _grid(k, m["x"]).alias("x"),
                    _grid(k, m["y"]).alias("y"))


def zone_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population of each neighborhood zone: customers per nation."""
    c = table(spark, sf_dir, "customer").select("c_nationkey")
    return (c.groupBy(F.col("c_nationkey").cast("long").alias("zone_id"))
            .agg(F.count(F.lit(1)).alias("population")))
