"""Column functions on the edge values of FIXTURES.md section 1.7."""

import pytest
from pyspark.sql import functions as F

from blockwise.functions import normalize as N

# (input, concat_text, concat_int, pair)
HOUSE_CASES = [
    ("7", 7, 7, (0, 7)),
    ("12-05", 1205, 125, (12, 5)),
    ("12 05", 1205, 125, (12, 5)),
    ("12 ", 12, 12, (0, 12)),
    ("12  34", 1234, 1234, (12, 34)),
    ("12-34-56", None, None, None),
    ("123A", None, None, None),
    ("NA", None, None, None),
    ("", None, None, None),
    ("-5", None, None, None),
    ("12-", None, None, None),
    ("12\n", None, None, None),
    ("99999999999", None, None, None),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def houses(spark):
    return spark.createDataFrame([(c[0],) for c in HOUSE_CASES], "h string")


@pytest.mark.parametrize("mode,idx", [("concat_text", 1), ("concat_int", 2), ("pair", 3)])
def test_house_number_modes(houses, mode, idx):
    rows = houses.select("h", N.parse_house_number("h", mode).alias("p")).collect()
    got = {r["h"]: (None if r["p"] is None else (r["p"]["block"], r["p"]["number"])) for r in rows}
    for case in HOUSE_CASES:
        want = case[idx]
        if want is not None and not isinstance(want, tuple):
            want = (0, want)
        assert got[case[0]] == want, (mode, case[0])


def test_house_number_ok(houses):
    rows = dict(houses.select("h", N.house_number_ok("h").alias("ok")).collect())
    assert rows["12-05"] and rows["12 "] and not rows["123A"] and not rows["12\n"]


def test_county_lookup_exact(spark):
    df = spark.createDataFrame([("NY",), ("NEW Y",), ("ny",), ("ZZ",), (None,), ("RICHMOND",)], "c string")
    got = [r[0] for r in df.select(N.code_lookup("c")).collect()]
    assert got == [1, 1, None, None, None, 5]


def test_dates(spark):
    df = spark.createDataFrame([("01/05/2017",), ("1/5/2017",), ("13/45/2017",), ("2014",), ("",),
                                (None,), ("2016-03-04",)], "d string")
    strict = [r[0] for r in df.select(N.year_from_text("d")).collect()]
    assert strict == [2017, 2017, None, None, None, None, None]
    lenient = [r[0] for r in df.select(N.year_lenient("d")).collect()]
    assert lenient == [2017, 2017, None, None, None, None, 2016]


def test_parity_and_onehot(spark):
    df = spark.createDataFrame([(4, 2017), (7, 2015), (None, 2020)], "n int, y int")
    assert [r[0] for r in df.select(N.parity("n")).collect()] == ["even", "odd", None]
    oh = df.select(*N.year_onehot("y", [2015, 2016, 2017])).collect()
    assert [tuple(r) for r in oh] == [(0, 0, 1), (1, 0, 0), (0, 0, 0)]


def test_safe_casts(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("x",), (None,)], "s string")
    r = df.select(N.safe_int("s").alias("i"), N.safe_double("s").alias("d")).collect()
    assert [(x["i"], x["d"]) for x in r] == [(12, 12.0), (None, 1.5), (None, None), (None, None)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from test_segments import parse as model_parse  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 -A\n", max_size=14), min_size=1, max_size=30))
def test_parse_matches_python_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "h string")
    for mode in ("pair", "concat_text", "concat_int"):
        got = [None if r[0] is None else (r[0]["block"], r[0]["number"])
               for r in df.select(N.parse_house_number("h", mode)).collect()]
        assert got == [model_parse(t, mode) for t in texts], mode


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 -A", max_size=14), min_size=1, max_size=30))
def test_sql_and_column_paths_agree(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts + [c[0] for c in HOUSE_CASES]], "h string")
    for mode in ("pair", "concat_text", "concat_int"):
        both = df.select(N.parse_house_number("h", mode).alias("a"),
                         N.parse_house_number(F.col("h"), mode).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in both), mode


def test_code_lookup_quotes(spark):
    df = spark.createDataFrame([("O'X",), ("a\\b",), ("Q",)], "c string")
    got = [r[0] for r in df.select(N.code_lookup("c", {"O'X": 7, "a\\b": 8})).collect()]
    assert got == [7, 8, None]
