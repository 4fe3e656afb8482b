"""S6 for layers of any size: one GeoJSON document read by many tasks, cut at feature borders.

The file is read in pieces that end at a closing brace, so Spark splits it like any text
file.  Whether a piece begins inside a string follows from the number of quotes before
it, its depth from the braces and brackets outside strings before it, and its feature
from the features that end before it.  Each of the three is a running sum over the file,
made of sums by split and running sums within a split, so no task sees a whole file.

Same rows as ``files.read_geojson_rings``, which is quicker for layers that fit one task.
A feature is an object directly within an array directly within the document, with
``"type": "Feature"``; other objects and arrays beside the features are passed over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockwise.operators.spatial import edges_from_rings
from blockwise.scratch import stored
from blockwise.sources.files import decode_feature, feature_schema

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NO_BRACE = rf'(?:[^"{{]++|{_STRING})*+'


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _with_sums_before(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``<column>_before``: the sum of the column over all earlier pieces of the file."""
    splits = rows.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    splits = splits.select("file", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_base") for c in columns])
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(splits, ["file", "block"]).select(
        *rows.columns, *[(F.col(f"{c}_base") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_before") for c in columns])


def read_pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, at, piece, quotes): the text up to each closing brace, the brace left out.

    block: where the split starts in the file; quotes: unescaped ones in the piece.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"),
                      _count(plain, '"').alias("quotes"))


def _structure(pieces: DataFrame) -> DataFrame:
    """Pieces with what stands outside strings: opened, braces and brackets (net, with the closing brace); inside: begins in a string."""
    rows = _with_sums_before(pieces, "quotes").withColumn("inside", F.col("quotes_before") % 2 == 1)
    plain = F.regexp_replace(F.concat(F.when(F.col("inside"), F.lit('"')).otherwise(F.lit("")), F.col("piece")), r"(?s)\\.", "")
    rows = rows.withColumn("marks", F.regexp_replace(plain, r'"[^"]*+(?:"|\z)', ""))
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    opened = _count(F.col("marks"), "{")
    return rows.select("file", "block", "at", "piece", "inside", opened.alias("opened"), closes.alias("closes"),
                       (opened - closes.cast("int")).alias("braces"),
                       (_count(F.col("marks"), "[") - _count(F.col("marks"), "]")).alias("brackets"))


def _features(pieces: DataFrame) -> DataFrame:
    """(file, number, feature): the text of every feature and its place among the file's features."""
    rows = _with_sums_before(_structure(pieces), "braces", "brackets")
    depth, arrays = F.col("braces_before"), F.col("brackets_before")
    ends = F.col("closes") & (depth + F.col("braces") == 1) & (arrays + F.col("brackets") == 1)
    starts = (depth <= 1) & (depth + F.col("opened") >= 2)
    # the brace that opens the feature is the first in the piece, or the second after the document's own
    tail = F.when(F.col("inside"), F.regexp_replace("piece", r'^[^"\\]*+(?:\\.[^"\\]*+)*+"', "")).otherwise(F.col("piece"))
    opening = (F.when(depth == 1, F.regexp_replace(tail, rf"(?s)\A{_NO_BRACE}", ""))
               .otherwise(F.regexp_replace(tail, rf"(?s)\A{_NO_BRACE}\{{{_NO_BRACE}", "")))
    rows = rows.select("file", "block", "at", ends.cast("int").alias("ends"), starts.alias("starts"),
                       F.when(starts, opening).otherwise(F.col("piece")).alias("piece"))
    rows = _with_sums_before(stored(rows, "geojson-pieces"), "ends").withColumnRenamed("ends_before", "number")
    each = rows.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "starts", "piece"))).alias("ps"), F.max("ends").alias("whole"))
    # objects before the features open and close in the first group: the feature is what its last start begins
    last = F.size("ps") - F.array_position(F.reverse(F.transform("ps", lambda p: p["starts"])), F.lit(True)).cast("int") + 1
    of_it = F.slice("ps", last, F.size("ps") - last + 1)
    text = F.concat(F.array_join(F.transform(of_it, lambda p: p["piece"]), "}"), F.lit("}"))
    return each.where("whole = 1").select("file", "number", text.alias("feature"))


def read_geojson_rings(spark: SparkSession, path: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """zone_id, ``attrs`` and rings of every feature, as ``files.read_geojson_rings`` gives them."""
    pieces = stored(read_pieces(spark, path), "geojson-text")
    found = _features(pieces)
    order = Window.orderBy("file")  # one row per file
    numbers = pieces.select("file").distinct().select("file", (F.row_number().over(order) - 1).cast("long").alias("_number"))
    parsed = found.join(numbers, "file").select(
        (F.col("_number") * (1 << 32) + F.col("number")).alias("zone_id"), F.from_json("feature", feature_schema(attrs).add("type", "string")).alias("f"))
    return decode_feature(parsed.where("f.type = 'Feature'"), attrs)


def read_geojson_edges(spark: SparkSession, path: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """A layer of any size as the edge list ``ZoneIndex`` takes."""
    return edges_from_rings(read_geojson_rings(spark, path, attrs), attrs=attrs)
