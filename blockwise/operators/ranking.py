"""Top-k per group, nesting and the line format of the ranked lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def top_k(df: DataFrame, group: str | Sequence[str], *, k: int = 3,
          order: Sequence[Column] | None = None, rank: str = "rank", salts: int = 0) -> DataFrame:
    """The first ``k`` rows of each group by ``order``.

    Default order: ``n`` descending, then ``zone_name`` ascending, so ties are
    broken deterministically.  ``row_number() <= k`` lets the planner insert a
    ``WindowGroupLimit`` below the shuffle, so at most k rows per group and
    map task are exchanged.  Fewer than k rows in a group is fine.

    The planner's limit ends at ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000).
    With ``salts`` rows are ranked within (group, salt) first and only the first ``k`` of
    each are ranked again, so a group with most of the rows is sorted by ``salts`` tasks
    for any ``k``.  The salt is a hash of the row; the result is the same.
    """
    groups = [group] if isinstance(group, str) else list(group)
    order = list(order) if order is not None else [F.col("n").desc(), F.col("zone_name").asc()]
    if salts > 1:
        df = _first_per_salt(df, groups, k, order, salts)
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def _first_per_salt(df: DataFrame, groups: list[str], k: int, order: list[Column], salts: int) -> DataFrame:
    """The rows that may be among the first ``k`` of their group: the first ``k`` of each of its salts."""
    taken = {c.lower() for c in df.columns}
    salt, place = (next(n for n in (f"{p}{'_' * i}" for i in range(99)) if n not in taken) for p in ("salt", "place"))
    hashed = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*hashed), F.lit(salts)))
    w = Window.partitionBy(*groups, salt).orderBy(*order)
    return salted.withColumn(place, F.row_number().over(w)).where(F.col(place) <= k).drop(salt, place)


def nest_top_k(ranked: DataFrame, group: str, *, rank: str = "rank",
               fields: Sequence[str] = ("zone_name", "n"), out: str = "top") -> DataFrame:
    """One row per group with ``array<struct<fields>>`` in rank order.

    Grouping on the window's partition key reuses its partitioning (no new
    exchange); each list holds at most k entries.
    """
    packed = F.struct(F.col(rank), *[F.col(f) for f in fields])
    items = F.array_sort(F.collect_list(packed))
    return ranked.groupBy(group).agg(
        F.transform(items, lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias(out))


def py_str_literal(s: Column) -> Column:
    """Python ``repr`` of a string: single quotes unless it holds ' and no "."""
    dq = F.concat(F.lit('"'), F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'))
    sq_body = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    sq = F.concat(F.lit("'"), sq_body, F.lit("'"))
    return F.when(F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"')), dq).otherwise(sq)


def format_topk_lines(nested: DataFrame, group: str, *, items: str = "top",
                      name: str = "zone_name", n: str = "n", out: str = "line") -> DataFrame:
    """K3: ``group,[('name', n), ...]`` per group, in group order (O1)."""
    pairs = F.transform(F.col(items), lambda s: F.concat(
        F.lit("("), py_str_literal(s[name]), F.lit(", "), s[n].cast("string"), F.lit(")")))
    line = F.concat(F.col(group).cast("string"), F.lit(",["), F.array_join(pairs, ", "), F.lit("]"))
    return nested.select(F.col(group), line.alias(out)).orderBy(group)


def limit_sorted(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """K4/O3: the first ``n`` rows in ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
