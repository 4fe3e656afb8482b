"""Closed-form least-squares slope over a fixed run of years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def slope_weights(xs: Sequence[int]) -> tuple[list[int], int]:
    """Integer weights w and denominator d with slope = sum(w_i * y_i) / d.

    From slope = (n*sum(xy) - sum(x)*sum(y)) / (n*sum(x^2) - sum(x)^2):
    w_i = n*x_i - sum(x), d = n*sum(x^2) - sum(x)^2.  Integer weights keep the
    numerator exact, so the result is the correctly rounded quotient (for
    2015..2019 it equals (-2*c1 - c2 + c4 + 2*c5) / 10 bit for bit).
    """
    n = len(xs)
    if n < 2:
        raise ValueError("need at least two x values")
    sx = sum(xs)
    d = n * sum(x * x for x in xs) - sx * sx
    if d == 0:
        raise ValueError("x values must not all be equal")
    return [n * x - sx for x in xs], d


def ols_slope(ys: Sequence[Column | str], xs: Sequence[int]) -> Column:
    """Slope of ys over fixed xs as a native double expression (no UDF).

    A null y gives a null slope; callers zero-fill counts first or use
    ``null_policy`` of ``yearly_trend``.
    """
    if len(ys) != len(xs):
        raise ValueError("ys and xs differ in length")
    w, d = slope_weights(xs)
    terms = [(F.col(y) if isinstance(y, str) else y).cast("double") * F.lit(float(wi))
             for y, wi in zip(ys, w) if wi != 0]
    num = terms[0]
    for t in terms[1:]:
        num = num + t
    return num / F.lit(float(d))
