"""Rows that the jobs drop, kept with their raw line, file, place and reason.

``tag_records`` reads each line raw, decodes it as ``read_positional`` does and names the
first rule that the row breaks; ``rejects`` keeps the broken ones and numbers them in
their files.  Rules of the four jobs are below.  A row that is read well but lies in no
zone or on no segment is no reject: the jobs' joins decide on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockwise.functions.normalize import code_lookup, parse_house_number
from blockwise.operators.cleaning import reject_reason
from blockwise.operators.range_join import record_year
from blockwise.sources import files

#: A noncharacter: no text holds it, so a line read with it as separator is one field.
NO_SEPARATOR = "\uffff"
PICKUP_POSITIONS = {i: n for i, n in files.TRIP_POSITIONS.items() if n.startswith("pickup")}

Rules = Mapping[str, Column]


def violation_rules(years: Sequence[int], *, mode: str = "pair", county_map: dict | None = None) -> Rules:
    """Job A: what a record needs to count in one of ``years``."""
    year = record_year("issue_date")
    return {"date": year.isNotNull(), "year": year.between(min(years), max(years)),
            "street": F.col("street_name").isNotNull(),
            "county": code_lookup(F.col("county"), county_map).isNotNull(),
            "house": parse_house_number("house_no", mode).isNotNull()}


def coordinate_rules(*columns: str) -> Rules:
    """Jobs B, C and D: coordinates that are numbers."""
    return {c: F.col(c).try_cast("double").isNotNull() for c in columns}


def tweet_rules() -> Rules:
    """Job C: coordinates and a text."""
    return {**coordinate_rules("lat", "lon"), "text": F.col("text").isNotNull()}


def read_lines(spark: SparkSession, path: str | Sequence[str], *, header: bool = False) -> DataFrame:
    """(raw, file, block, at): the lines that ``read_positional`` reads, whole.

    The first line of each file is left out with ``header``, blank lines always.  block: where the
    file's split starts; at: a number that grows along the lines of a split.
    """
    raw = (spark.read.schema("raw string").option("header", header).option("sep", NO_SEPARATOR)
           .option("quote", "").option("mode", "PERMISSIVE").csv(path))
    return raw.select("raw", F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("at"))


def tag_records(lines: DataFrame, positions: Mapping[int, str], rules: Rules, *, sep: str = ",",
                quote: str = '"', escape: str = '"') -> DataFrame:
    """``lines`` of ``read_lines`` with the named fields and the reason of the first broken rule (null: clean)."""
    width = max(positions) + 1
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", **({"escape": escape} if quote else {})}
    fields = F.from_csv("raw", ", ".join(f"_c{i} string" for i in range(width)), options)
    # the array keeps the decoded line a single computation, whatever reads its fields
    each = lines.select("*", F.explode(F.array(fields)).alias("_f"))
    named = each.select(*lines.columns, *[F.col(f"_f._c{i}").alias(n) for i, n in sorted(positions.items())])
    return named.withColumn("reason", reject_reason(rules))


def rejects(spark: SparkSession, path: str | Sequence[str], positions: Mapping[int, str], rules: Rules, *,
            header: bool = False, sep: str = ",", quote: str = '"', escape: str = '"') -> DataFrame:
    """(file, record, raw, reason) of every line that breaks a rule.

    record: the line's 0-based number among the records of its file (header and blank lines not
    counted).  Lines are counted once a split, so only rejects and one row a split are shuffled.  If
    Spark splits the files otherwise for the two reads (the cluster grew between them), record is null;
    no reject is lost.
    """
    lines = read_lines(spark, path, header=header)
    broken = tag_records(lines, positions, rules, sep=sep, quote=quote, escape=escape).where("reason IS NOT NULL")
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return broken.join(splits, ["file", "block"], "left").select(
        "file", (F.col("before") + F.col("at") - F.col("first")).alias("record"), "raw", "reason")


def violation_rejects(spark: SparkSession, path, years: Sequence[int], *, mode: str = "pair",
                      county_map: dict | None = None, header: bool = True) -> DataFrame:
    """Job A: the violations that are dropped before the segment join."""
    return rejects(spark, path, files.VIOLATION_POSITIONS, violation_rules(years, mode=mode, county_map=county_map), header=header)


def trip_rejects(spark: SparkSession, path, *, header: bool = True, positions: Mapping[int, str] = files.TRIP_POSITIONS) -> DataFrame:
    """Job B: trips without readable coordinates; job D needs ``PICKUP_POSITIONS`` only."""
    return rejects(spark, path, positions, coordinate_rules(*[n for _, n in sorted(positions.items())]), header=header)


def tweet_rejects(spark: SparkSession, path) -> DataFrame:
    """Job C: posts without readable coordinates or text."""
    return rejects(spark, path, files.TWEET_POSITIONS, tweet_rules(), sep="|", quote="")


def reject_counts(rejected: DataFrame) -> DataFrame:
    """(file, reason, n) of ``rejects``."""
    return rejected.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
