"""Segment attribution against a brute-force Python model."""

import random
import re

import pytest

from blockwise.operators.range_join import attribute_to_segments, side_table
from blockwise.operators.segments import segment_sides
from blockwise.plans.jobs import segment_trend

YEARS = [2015, 2016, 2017, 2018, 2019]
CODES = {"NY": 1, "MN": 1, "BX": 2, "K": 3, "QN": 4, "R": 5}
SHAPE = re.compile(r"^([0-9]+)(?:[ -]+([0-9]+))?$")


def parse(text, mode):
    if text is None:
        return None
    t = text.strip(" ")
    m = SHAPE.match(t) if "\n" not in t else None
    if not m:
        return None
    a, b = m.group(1), m.group(2)
    if mode == "concat_text":
        v = int(a + (b or ""))
        res = (0, v)
    elif mode == "concat_int":
        res = (0, int(str(int(a)) + (str(int(b)) if b else "")))
    else:
        res = (int(a), int(b)) if b else (0, int(a))
    return None if any(x > 2**31 - 1 for x in res) else res


def brute(records, segments, mode, keep, compare="component"):
    sides = set()
    for pid, st, full, boro, ll, lh, rl, rh in segments:
        for side, lo, hi in (("L", ll, lh), ("R", rl, rh)):
            plo, phi = parse(lo, mode), parse(hi, mode)
            if plo is None or phi is None:
                continue
            par = plo[1] % 2
            for name in (st, full):
                if name is not None:
                    sides.add((pid, side, name.upper(), boro, par, plo, phi))
    out, unmatched = {}, [0] * 5
    for street, county, house, year in records:
        h = parse(house, "pair" if mode == "pair" else mode)
        if street is None or county not in CODES or h is None or not 2015 <= year <= 2019:
            continue
        hit = False
        for pid, side, name, boro, par, lo, hi in sides:
            if name != street.upper() or boro != CODES[county] or h[1] % 2 != par:
                continue
            if compare == "component":
                ok = lo[0] <= h[0] <= hi[0] and lo[1] <= h[1] <= hi[1]
            else:
                ok = lo <= h <= hi
            if ok:
                hit = True
                out.setdefault(pid, [0] * 5)[year - 2015] += 1
        if not hit:
            unmatched[year - 2015] += 1
    if keep == "records":
        out[None] = unmatched
    if keep == "segments":
        for s in segments:
            out.setdefault(s[0], [0] * 5)
    return {k: tuple(v) for k, v in out.items()}


SEG_SCHEMA = ("physical_id long, st_name string, full_street string, borough int, "
              "l_low string, l_high string, r_low string, r_high string")
REC_SCHEMA = "street_name string, county string, house_no string, issue_year int"

SEGMENTS = [
    (1, "MAIN ST", "MAIN ST", 1, "1", "99", "2", "98"),        # both names equal
    (2, "OAK AV", "OAK AVENUE", 1, "101", "199", "X", "198"),  # right side invalid
    (3, "ELM ST", "ELM ST", 2, "2", "50", "1", "49"),          # left side even
    (4, "PINE ST", "PINE ST", 3, "1", "9", "2", "8"),          # no records
    (5, "BLOCK RD", "BLOCK RD", 4, "10-05", "12-03", "10-06", "12-04"),
    (6, "LONG RD", "LONG RD", 5, "1", "99999", "2", "99998"),  # very long range
]
RECORDS = [
    ("main st", "NY", "7", 2015), ("MAIN ST", "MN", "8", 2016), ("MAIN ST", "NY", "7", 2019),
    ("OAK AV", "NY", "151", 2017), ("OAK AVENUE", "NY", "150", 2017), ("OAK AV", "ny", "151", 2017),
    ("ELM ST", "BX", "12", 2018), ("ELM ST", "BX", "13", 2018), ("ELM ST", "BX", "12 ", 2016),
    ("BLOCK RD", "QN", "11-21", 2015), ("BLOCK RD", "QN", "10-05", 2015), ("BLOCK RD", "QN", "12-01", 2019),
    ("LONG RD", "R", "50001", 2017), ("LONG RD", "R", "50002", 2018), ("NOWHERE", "K", "5", 2015),
    ("MAIN ST", "NY", "123A", 2015), ("MAIN ST", "NY", "5", 2014), (None, "NY", "5", 2015),
]


def spark_result(spark, records, segments, **kw):
    r = spark.createDataFrame(records, REC_SCHEMA)
    s = spark.createDataFrame(segments, SEG_SCHEMA)
    df = segment_trend(r, s, YEARS, **kw)
    return {row["physical_id"]: tuple(row[f"count_{y}"] for y in YEARS) for row in df.collect()}


@pytest.mark.parametrize("mode", ["pair", "concat_text", "concat_int"])
@pytest.mark.parametrize("keep", ["matched", "records", "segments"])
def test_keep_modes_match_brute_force(spark, mode, keep):
    got = spark_result(spark, RECORDS, SEGMENTS, mode=mode, keep=keep)
    assert got == brute(RECORDS, SEGMENTS, mode, keep)


@pytest.mark.parametrize("compare", ["component", "lexicographic"])
def test_compare_modes(spark, compare):
    got = spark_result(spark, RECORDS, SEGMENTS, mode="pair", keep="matched", compare=compare)
    assert got == brute(RECORDS, SEGMENTS, "pair", "matched", compare)


def test_component_excludes_middle_block(spark):
    comp = spark_result(spark, RECORDS, SEGMENTS, mode="pair", compare="component")
    lex = spark_result(spark, RECORDS, SEGMENTS, mode="pair", compare="lexicographic")
    # Component-wise, 10-05..12-03 needs 5 <= number <= 3: nothing matches.
    # Lexicographically 10-05, 11-21 (2015) and 12-01 (2019) all lie inside.
    assert 5 not in comp and lex[5] == (2, 0, 0, 0, 1)


def test_wide_ranges_and_no_broadcast_agree(spark):
    base = spark_result(spark, RECORDS, SEGMENTS, mode="pair", keep="records")
    # bucket width 1 makes every range "wide"; broadcast_rows=0 forces shuffle joins
    r = spark.createDataFrame(RECORDS, REC_SCHEMA)
    s = spark.createDataFrame(SEGMENTS, SEG_SCHEMA)
    for kw in ({"bucket_width": 1}, {"broadcast_rows": 0}, {"bucket_width": 1, "broadcast_rows": 0}):
        df = segment_trend(r, s, YEARS, mode="pair", keep="records", **kw)
        got = {row["physical_id"]: tuple(row[f"count_{y}"] for y in YEARS) for row in df.collect()}
        assert got == base, kw


def test_random_against_brute_force(spark):
    rnd = random.Random(7)
    names = ["A ST", "B ST", "C ST"]
    segs = []
    for pid in range(40):
        lo = rnd.randint(0, 300)
        segs.append((pid, rnd.choice(names), rnd.choice(names), rnd.randint(1, 3),
                     str(lo * 2 + 1), str(lo * 2 + 1 + 2 * rnd.randint(0, 150)),
                     str(lo * 2), str(lo * 2 + 2 * rnd.randint(0, 150))))
    recs = [(rnd.choice(names), rnd.choice(["NY", "BX", "K", "ZZ"]),
             rnd.choice([str(rnd.randint(0, 900)), f"{rnd.randint(1, 9)}-{rnd.randint(0, 99):02d}", "1A"]),
             rnd.randint(2014, 2020)) for _ in range(600)]
    for mode in ("pair", "concat_text"):
        for keep in ("matched", "records", "segments"):
            got = spark_result(spark, recs, segs, mode=mode, keep=keep, bucket_width=50)
            assert got == brute(recs, segs, mode, keep), (mode, keep)


def test_segment_sides_rows(spark):
    s = spark.createDataFrame(SEGMENTS[:3], SEG_SCHEMA)
    rows = segment_sides(s, mode="pair").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["physical_id"], []).append((r["side"], r["street"], r["parity"]))
    assert sorted(by_id[1]) == [("L", "MAIN ST", "odd"), ("R", "MAIN ST", "even")]
    assert sorted(by_id[2]) == [("L", "OAK AV", "odd"), ("L", "OAK AVENUE", "odd")]
    assert ("L", "ELM ST", "even") in by_id[3]
    raw = segment_sides(s, mode="pair", dedup=False).count()
    assert raw == 4 + 2 + 4


def test_null_segment_id_and_all_matched(spark):
    segs = SEGMENTS + [(None, "MAIN ST", "MAIN ST", 1, "1", "99", "2", "98")]
    for kw in ({}, {"bucket_width": 1}):   # single-join path and wide-range path
        got = spark_result(spark, RECORDS, segs, mode="pair", keep="records", **kw)
        assert got == brute(RECORDS, SEGMENTS, "pair", "records"), kw
        segs_only = spark_result(spark, RECORDS, segs, mode="pair", keep="segments", **kw)
        assert None not in segs_only
    matched_only = [r for r in RECORDS if r[0] == "MAIN ST" and r[2] in ("7", "8") and r[3] >= 2015]
    for kw in ({}, {"bucket_width": 1}):
        got = spark_result(spark, matched_only, SEGMENTS, mode="pair", keep="records", **kw)
        assert None not in got, kw           # nothing unmatched: no null row


def test_dyadic_cover_is_disjoint_and_whole(spark):
    from blockwise.operators.range_join import dyadic_cover
    rnd = random.Random(11)
    ranges = [(0, 0), (5, 4), (0, 1023), (1, 1022), (7, 7)] + [(lo := rnd.randint(0, 3_000), lo + rnd.randint(-1, 3_000)) for _ in range(60)]
    frame = spark.createDataFrame(ranges, "lo long, hi long").select("lo", "hi", dyadic_cover("lo", "hi").alias("n"))
    for lo, hi, nodes in frame.collect():
        held = [p for k, v in nodes or [] for p in range(v << k, (v + 1) << k)]
        assert sorted(held) == list(range(lo, hi + 1)), (lo, hi)
        assert len(nodes or []) <= 2 * max(1, (hi - lo + 1).bit_length())


@pytest.mark.parametrize("compare", ["component", "lexicographic"])
@pytest.mark.parametrize("keep", ["matched", "records", "segments"])
def test_ranges_across_blocks_take_one_join(spark, compare, keep):
    rnd = random.Random(5)

    def bound():
        return f"{rnd.randint(1, 40)}-{rnd.randint(0, 99):02d}"
    segs = [(pid, rnd.choice(["A ST", "B ST"]), "C ST", 1, *sorted((bound(), bound())), *sorted((bound(), bound()))) for pid in range(40)]
    recs = [(rnd.choice(["A ST", "B ST", "C ST"]), "NY", rnd.choice([bound(), f"{rnd.randint(1, 40)}-9999999", "12"]), rnd.randint(2015, 2019))
            for _ in range(400)]
    assert spark_result(spark, recs, segs, mode="pair", keep=keep, compare=compare) == brute(recs, segs, "pair", keep, compare)


def test_one_join_and_no_square_on_a_long_street(spark):
    """Cross-block ranges of one street meet their own positions, not the street."""
    n = 3_000
    sides = spark.range(n).selectExpr("id AS physical_id", "'LONG ST' AS street", "1 AS borough", "'odd' AS parity", "CAST(id AS INT) AS low_block",
                                      "90 AS low_number", "CAST(id + 1 AS INT) AS high_block", "9 AS high_number")
    recs = spark.range(n).selectExpr("'LONG ST' AS street", "1 AS borough", "'odd' AS parity", "CAST(id AS INT) AS block", "95 AS number", "1L AS count_2015")
    out = attribute_to_segments(recs, sides, count_cols=["count_2015"], compare="lexicographic", broadcast=False)
    assert out.count() == n and out.agg({"count_2015": "sum"}).first()[0] == n
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    join = next(line for line in plan.splitlines() if "Join " in line)
    assert "node#" in join and "level#" in join
    table, rows, levels = side_table(sides)
    pairs = recs.crossJoin(spark.createDataFrame([(k,) for k in levels], "level int")).selectExpr("level", "shiftright(shiftleft(CAST(block AS BIGINT), 16), level) AS node") \
        .join(table.select("level", "node"), ["level", "node"]).count()
    assert rows <= 4 * n and pairs <= 8 * n
