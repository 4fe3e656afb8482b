"""Closed-form slope vs. least squares, and the null policies."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockwise.functions.trend import ols_slope, slope_weights
from blockwise.operators import trend as T

YEARS = [2015, 2016, 2017, 2018, 2019]


def test_weights_five_years():
    w, d = slope_weights(YEARS)
    assert [x / d for x in w] == [-0.2, -0.1, 0.0, 0.1, 0.2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=5, max_size=5))
def test_weights_match_polyfit(ys):
    w, d = slope_weights(YEARS)
    ours = sum(a * b for a, b in zip(w, ys)) / d
    assert abs(ours - np.polyfit(YEARS, ys, 1)[0]) < 1e-6 * max(1, max(ys))


def test_slope_expression_and_policies(spark):
    cols = [f"c{y}" for y in YEARS]
    df = spark.createDataFrame([(1, 1, 2, 3, 4, 5), (2, None, 0, 0, 0, 10)],
                               "k int, " + ", ".join(f"{c} bigint" for c in cols))
    exact = df.select("k", ols_slope(cols, YEARS).alias("s")).orderBy("k").collect()
    assert exact[0]["s"] == 1.0 and exact[1]["s"] is None
    z = T.add_slope(df, cols, YEARS, null_policy="zero_fill").orderBy("k").collect()
    assert z[1]["ols_coeff"] == (2 * 10) / 10 and z[1]["c2015"] == 0
    zs = T.add_slope(df, cols, YEARS, null_policy="zero_slope").orderBy("k").collect()
    assert zs[1]["ols_coeff"] == 0.0 and zs[1]["c2015"] is None


def test_long_form_matches_wide(spark):
    cols = [f"c{y}" for y in YEARS]
    rng = np.random.default_rng(1)
    rows = [(i, *map(int, rng.integers(0, 50, 5))) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} bigint" for c in cols))
    wide = {r["k"]: r["ols_coeff"] for r in T.add_slope(df, cols, YEARS).collect()}
    long = T.slope_long(T.to_long(df, "k", cols, YEARS), "k")
    for r in long.collect():
        assert abs(r["ols_coeff"] - wide[r["k"]]) < 1e-9


def test_pivot_and_counts(spark):
    df = spark.createDataFrame([("a", 2015), ("a", 2015), ("a", 2017), ("b", 2016)], "s string, y int")
    c = T.count_all_columns(df)
    p = {r["s"]: tuple(r[1:]) for r in T.pivot_years(c, ["s"], "y", "n", [2015, 2016, 2017]).collect()}
    assert p == {"a": (2, None, 1), "b": (None, 1, None)}
    yc = {r["s"]: tuple(r[1:]) for r in T.yearly_counts(df, ["s"], "y", [2015, 2016, 2017]).collect()}
    assert yc == {"a": (2, 0, 1), "b": (0, 1, 0)}


def test_yearly_trend(spark):
    df = spark.createDataFrame([("a", 2015), ("a", 2019), ("a", 2019), ("b", 2017)], "s string, y int")
    got = {r["s"]: (r["count_2015"], r["count_2019"], r["ols_coeff"])
           for r in T.yearly_trend(df, "s", "y", YEARS).collect()}
    assert got == {"a": (1, 2, (-2 + 4) / 10), "b": (0, 0, 0.0)}


@settings(max_examples=100, deadline=None)
@given(st.integers(1990, 2030), st.integers(2, 9), st.data())
def test_weights_any_window(first, n, data):
    xs = list(range(first, first + n))
    ys = data.draw(st.lists(st.integers(0, 10**5), min_size=n, max_size=n))
    w, d = slope_weights(xs)
    assert abs(sum(a * b for a, b in zip(w, ys)) / d - np.polyfit(xs, ys, 1)[0]) < 1e-6 * max(1, max(ys))


def test_slope_expression_other_window(spark):
    xs = [2010, 2011, 2012]
    df = spark.createDataFrame([(1, 4, 9)], "a bigint, b bigint, c bigint")
    got = df.select(ols_slope(["a", "b", "c"], xs).alias("s")).first()["s"]
    assert got == np.polyfit(xs, [1, 4, 9], 1)[0] or abs(got - 4.0) < 1e-12
