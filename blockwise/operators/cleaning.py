"""Null handling and malformed-row splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows with a null in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def fill_zero(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """nulls of the named numeric columns become 0 (ids stay null)."""
    return df.fillna(0, subset=list(subset))


def split_rejects(df: DataFrame, valid: Column, flag: str = "rejected") -> DataFrame:
    """mark rows failing ``valid`` (null counts as failing) instead of dropping.

    Callers filter on the flag for the clean rows and count the rejects from
    the same scan; nothing fails the job.
    """
    return df.withColumn(flag, ~F.coalesce(valid, F.lit(False)))


def reject_reason(valid: Mapping[str, Column]) -> Column:
    """the first name whose condition does not hold (null counts as failing), null for a clean row."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in valid.items()])
