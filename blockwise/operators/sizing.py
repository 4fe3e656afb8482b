"""Size checks that gate every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound under which a side input may be broadcast.  The rows we
# broadcast are narrow: a segment side is ~120 bytes (ids, a street name,
# four ints), a cell-table entry ~50 bytes (a cell key or one edge of four
# doubles).  One million rows keeps a broadcast near 100 MiB, which fits an
# executor comfortably; a real city's street centerline (~1e5 segments, up to
# four sides each, about one range bucket per side) stays under it.
DEFAULT_BROADCAST_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True iff ``df`` has at most ``max_rows`` rows.

    ``limit(max_rows + 1).count()`` stops reading once the bound is passed,
    so the check costs at most ``max_rows + 1`` rows of work, never a scan of
    a large table to the end.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                    force: bool | None = None) -> tuple[DataFrame, bool]:
    """Broadcast-hint ``df`` only after proving it has at most ``max_rows`` rows.

    ``force=True/False`` skips the check (tests, or a caller that already
    knows).  Beyond the bound the frame is returned unhinted and the join is
    planned as a shuffle join (AQE may still convert it from runtime sizes).
    """
    if force is not None:
        ok = force
    else:
        ok = max_rows is not None and row_count_at_most(df, max_rows)
    return (F.broadcast(df), True) if ok else (df, False)
