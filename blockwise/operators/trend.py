"""Per-key yearly counts, pivots and the least-squares trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwise.functions.trend import ols_slope

NULL_POLICIES = ("zero_fill", "zero_slope", "null")


def add_slope(df: DataFrame, count_cols: Sequence[str], years: Sequence[int], *,
              null_policy: str = "zero_fill", out: str = "ols_coeff") -> DataFrame:
    """P17 on wide counts.

    ``zero_fill``   null counts become 0 first (F6), then the slope
    ``zero_slope``  counts stay as they are; any null count gives slope 0.0
    ``null``        counts stay; any null count gives a null slope
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    if null_policy == "zero_fill":
        df = df.fillna(0, subset=list(count_cols))
    slope = ols_slope(list(count_cols), list(years))
    if null_policy == "zero_slope":
        slope = F.coalesce(slope, F.lit(0.0))
    return df.withColumn(out, slope)


def yearly_counts(df: DataFrame, keys: Sequence[str], year: str,
                  years: Sequence[int], prefix: str = "count_") -> DataFrame:
    """A3/A4: one count column per year for each key (conditional counts)."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(year) == F.lit(y)).alias(f"{prefix}{y}")
                                   for y in years])


def pivot_years(df: DataFrame, keys: Sequence[str], year: str, value: str,
                years: Sequence[int], prefix: str = "count_") -> DataFrame:
    """Pivot with explicit year values, ``max`` per cell; missing -> null.

    Explicit values spare the distinct-values job a bare ``pivot`` runs.
    """
    p = df.groupBy(*keys).pivot(year, list(years)).agg(F.max(value))
    return p.select(*keys, *[F.col(str(y)).alias(f"{prefix}{y}") for y in years])


def count_all_columns(df: DataFrame, out: str = "n") -> DataFrame:
    """A5: multiplicity of identical rows (group by every column)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(out))


def to_long(df: DataFrame, key: str, count_cols: Sequence[str], years: Sequence[int],
            year_col: str = "year", value_col: str = "n") -> DataFrame:
    """Wide per-year counts -> (key, year, n) rows with a narrow ``explode``."""
    pairs = F.array(*[F.struct(F.lit(y).alias(year_col), F.col(c).cast("double").alias(value_col))
                      for y, c in zip(years, count_cols)])
    return df.select(key, F.explode(pairs).alias("p")).select(key, f"p.{year_col}", f"p.{value_col}")


def slope_long(df: DataFrame, key: str, year_col: str = "year", value_col: str = "n",
               out: str = "ols_coeff") -> DataFrame:
    """``regr_slope`` over long rows; null values are skipped."""
    return df.groupBy(key).agg(F.regr_slope(F.col(value_col), F.col(year_col).cast("double"))
                               .alias(out))


def yearly_trend(df: DataFrame, key: str | Sequence[str], year: str, years: Sequence[int], *,
                 null_policy: str = "zero_fill", prefix: str = "count_") -> DataFrame:
    """Per key: one count per year and the OLS slope over ``years``."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = yearly_counts(df, keys, year, years, prefix=prefix)
    return add_slope(counts, [f"{prefix}{y}" for y in years], years, null_policy=null_policy)
