"""Writers for job results (K1, K2) and rejected rows.

Results are written by the executors straight to storage; nothing passes
through the driver.  An existing path is an error unless ``mode`` says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, *, header: bool = False, mode: str = "errorifexists") -> None:
    """K1: a directory of CSV part files (no header by default)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_lines(df: DataFrame, column: str, path: str, *, mode: str = "errorifexists") -> None:
    """K2: one text line per row from a string column (e.g. formatted top-k)."""
    df.select(column).write.mode(mode).text(path)


def write_rejects(rejected: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Rejected rows (file, record, raw, reason) as Parquet, one folder a reason."""
    rejected.write.mode(mode).partitionBy("reason").parquet(path)
