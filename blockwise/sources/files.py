"""Readers for the raw inputs of the four jobs.

All readers declare their schema (no inference pass over the data) and read
by position, so only the needed columns come out of the CSV parser.  Every
file of a directory is read; ``header=True`` drops the first line of *each*
file.  Malformed values become null in the typed columns (PERMISSIVE mode
plus ``try_cast``), never a failed job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from blockwise.operators.spatial import edges_from_rings

# ---------------------------------------------------------------------------
# Column positions (0-based) of the public source files.
VIOLATION_POSITIONS = {4: "issue_date", 21: "county", 23: "house_no", 24: "street_name"}
CENTERLINE_POSITIONS = {0: "physical_id", 2: "l_low", 3: "l_high", 4: "r_low", 5: "r_high",
                        13: "borough", 28: "full_street", 29: "st_name"}
TRIP_POSITIONS = {5: "pickup_lon", 6: "pickup_lat", 9: "dropoff_lon", 10: "dropoff_lat"}
TWEET_POSITIONS = {1: "lat", 2: "lon", 6: "text"}
# ---------------------------------------------------------------------------


def read_positional(spark: SparkSession, path: str | Sequence[str], positions: Mapping[int, str],
                    *, header: bool = False, sep: str = ",", quote: str = '"',
                    escape: str = '"') -> DataFrame:
    """Delimited text -> named string columns picked by position.

    The schema lists ``max(position) + 1`` string columns, so a line with
    more fields is cut and one with fewer is padded with nulls.  Quoting
    follows RFC 4180 (``"x ""y"", z"`` is one field) unless ``quote=''``.
    """
    width = max(positions) + 1
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    reader = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE").option("quote", quote))
    if quote:
        reader = reader.option("escape", escape)
    df = reader.csv(path)
    return df.select(*[F.col(f"_c{i}").alias(name) for i, name in sorted(positions.items())])


def read_violations(spark: SparkSession, path, *, header: bool = True) -> DataFrame:
    """Parking violations: issue_date, county, house_no, street_name (text)."""
    return read_positional(spark, path, VIOLATION_POSITIONS, header=header)


def read_centerline(spark: SparkSession, path, *, header: bool = True) -> DataFrame:
    """Street centerline: physical_id (long), names, borough (int), bounds (text)."""
    df = read_positional(spark, path, CENTERLINE_POSITIONS, header=header)
    return df.select(F.col("physical_id").try_cast("long").alias("physical_id"),
                     "st_name", "full_street", F.col("borough").try_cast("int").alias("borough"),
                     "l_low", "l_high", "r_low", "r_high")


def read_trips(spark: SparkSession, path, *, header: bool = True,
               positions: Mapping[int, str] = TRIP_POSITIONS) -> DataFrame:
    """Taxi trips: pickup/drop-off coordinates as double (null if unparseable)."""
    df = read_positional(spark, path, positions, header=header)
    return df.select(*[F.col(c).try_cast("double").alias(c) for c in df.columns])


def read_tweets(spark: SparkSession, path) -> DataFrame:
    """Pipe-delimited tweets without header or quoting: lat, lon (double), text."""
    df = read_positional(spark, path, TWEET_POSITIONS, sep="|", quote="")
    return df.select(F.col("lat").try_cast("double").alias("lat"),
                     F.col("lon").try_cast("double").alias("lon"), "text")


def read_word_lists(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One term per line of every file, kept as written (no trim)."""
    return spark.read.text(paths).select(F.col("value").alias("term"))


_POLYGON = "array<array<array<double>>>"
_MULTIPOLYGON = "array<array<array<array<double>>>>"


def feature_schema(attrs: Sequence[str]) -> StructType:
    """A feature's properties as text and its geometry with the coordinates as raw JSON text."""
    props = StructType([StructField(a, StringType()) for a in attrs])
    geom = StructType([StructField("type", StringType()), StructField("coordinates", StringType())])
    return StructType([StructField("properties", props), StructField("geometry", geom)])


def decode_feature(features: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """zone_id, ``attrs`` and rings from ``features`` (zone_id, f of ``feature_schema``)."""
    gtype, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    rings = (F.when(gtype == "Polygon", F.from_json(coords, _POLYGON))
             .when(gtype == "MultiPolygon", F.flatten(F.from_json(coords, _MULTIPOLYGON))))
    as_xy = F.transform(rings, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return features.select(F.col("zone_id").cast("long").alias("zone_id"),
                           *[F.col(f"f.properties.{a}").alias(a) for a in attrs],
                           as_xy.alias("rings"))


def read_geojson_rings(spark: SparkSession, path: str, attrs: Sequence[str]) -> DataFrame:
    """A GeoJSON FeatureCollection -> one row per feature.

    Columns: zone_id (0-based feature index; 2^32 more for each file before in a
    layer of several files), the ``attrs`` properties as
    text, rings ``array<array<struct<x,y>>>`` holding every ring of every
    part (outer rings and holes alike).  Coordinates are read as raw JSON
    text and decoded per geometry type.
    """
    schema = StructType([StructField("features", ArrayType(feature_schema(attrs)))])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    # Files are numbered in name order; a lone file's ids are its feature positions.
    named = raw.select(F.input_file_name().alias("_file"), F.posexplode("features").alias("_pos", "f"))
    order = Window.orderBy("_file")  # one row per file
    files = raw.select(F.input_file_name().alias("_file")).distinct().select(
        "_file", (F.row_number().over(order) - 1).cast("long").alias("_number"))
    f = named.join(files, "_file").withColumn("zone_id", F.col("_number") * (1 << 32) + F.col("_pos"))
    return decode_feature(f, attrs)


def read_geojson_edges(spark: SparkSession, path: str, attrs: Sequence[str]) -> DataFrame:
    """GeoJSON layer as the edge list ``ZoneIndex`` takes."""
    return edges_from_rings(read_geojson_rings(spark, path, attrs), attrs=attrs)
