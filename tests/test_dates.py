"""Date text of any usual shape, against a table of cases and the calendar."""

import calendar
import random

import pytest

from blockwise.functions import normalize as N
from blockwise.operators.range_join import count_bad_dates

CASES = {
    "1/5/2017": (2017, 1, 5), "01/05/2017": (2017, 1, 5), "1/5/17": (2017, 1, 5), "13/5/2017": (2017, 5, 13), "5/13/2017": (2017, 5, 13),
    "1-5-2017": (2017, 1, 5), "1.5.17": (2017, 1, 5), "2017-05-01": (2017, 5, 1), "2017/5/1": (2017, 5, 1), "20170501": (2017, 5, 1),
    "2017-05-01T10:00": (2017, 5, 1), "2017-05-01 10:00:30.123456": (2017, 5, 1), "2017-05-01T10:00:30Z": (2017, 5, 1),
    "2017-05-01T10:00:30+02:00": (2017, 5, 1), "1/5/2017 10:00 PM": (2017, 1, 5), "1/5/2017 10:00:01pm": (2017, 1, 5), "1/5/2017 10 pm": (2017, 1, 5),
    "5 Jan 2017": (2017, 1, 5), "5 january 2017 10:00": (2017, 1, 5), "5th Jan, 2017": (2017, 1, 5), "05-May-17": (2017, 5, 5),
    "January 5, 2017": (2017, 1, 5), "January 5th, 2017": (2017, 1, 5), "Jan. 5 2017": (2017, 1, 5), "Sept 1 2017": (2017, 9, 1), "MAY 3 2017": (2017, 5, 3),
    "2017 May 5": (2017, 5, 5), "Thu, 5 Jan 2017 10:00:00 GMT": (2017, 1, 5), "Thursday, January 5, 2017 at 10:00 AM": (2017, 1, 5),
    " 1/5/2017\t": (2017, 1, 5), "1/5/69": (1969, 1, 5), "1/5/68": (2068, 1, 5), "1/5/00": (2000, 1, 5), "2/29/2016": (2016, 2, 29), "2/29/2000": (2000, 2, 29),
    "2/29/2017": None, "2/29/1900": None, "13/45/2017": None, "4/31/2017": None, "0/5/2017": None, "": None, None: None, "2017": None, "5 2017": None,
    "1/5": None, "hello": None, "1/5/2017 x": None, "x 1/5/2017": None, "1//5/2017": None, "1/5/201": None, "20171301": None, "2017-05": None,
    "5 May 10:00": None, "12345": None, "99999999999999999999": None, "1/5/0000": None, "\u0661/5/2017": None, "1/5/2017 10:00 10:00": None,
    "9" * 50_000: None,
}


def test_cases(spark):
    rows = list(CASES.items())
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, d string")
    got = {r["i"]: r["f"] and tuple(r["f"]) for r in frame.select("i", N.date_fields("d").alias("f")).collect()}
    assert {rows[i][0]: v for i, v in got.items()} == CASES
    assert {rows[r["i"]][0]: r["y"] for r in frame.select("i", N.year_any("d").alias("y")).collect()} == {t: v and v[0] for t, v in CASES.items()}
    bad = count_bad_dates(frame, "d").first()
    assert (bad["n"], bad["n_bad"]) == (len(rows), sum(v is None for v in CASES.values()))


@pytest.mark.parametrize("shape", ["{m}/{d}/{y:04d}", "{y:04d}-{m:02d}-{d:02d}", "{d} {name} {y:04d}", "{name} {d}, {y:04d} 1:02:03 am", "{y:04d}{m:02d}{d:02d}"])
def test_every_day_and_no_other(spark, shape):
    rng = random.Random(shape)
    days = [(rng.randint(1, 2100), rng.randint(1, 13), rng.randint(0, 33)) for _ in range(300)]
    names = ["?", *N.MONTH_NAMES, "nomonth"]
    frame = spark.createDataFrame([(k, shape.format(y=y, m=m, d=d, name=names[m])) for k, (y, m, d) in enumerate(days)], "k int, d string")
    both = frame.select("k", N.date_fields("d").alias("f"), N.year_any("d").alias("y")).collect()
    assert all(r["y"] == (r["f"] and r["f"]["year"]) for r in both)
    got = {r["k"]: r["f"] and tuple(r["f"]) for r in both}
    for k, (y, m, d) in enumerate(days):
        real = m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]
        if shape.startswith("{m}") and m == 13 and 1 <= d <= 12:
            assert got[k] == (y, d, m)      # over 12 can only be the day
        else:
            assert got[k] == ((y, m, d) if real else None), days[k]
