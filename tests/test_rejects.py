"""Rejected rows: raw line, file, record number and reason; counts that add up."""

import os

from blockwise.plans import cli
from blockwise.sources import files, rejects

YEARS = range(2015, 2020)


def violation(date="1/5/2017", county="NY", house="12-05", street="MAIN ST"):
    cols = ["x"] * 25
    cols[4], cols[21], cols[23], cols[24] = date, county, house, street
    return ",".join(cols)


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_violation_rejects_have_line_file_record_and_reason(spark, tmp_dir):
    header = ",".join(f"h{i}" for i in range(25))
    a = [header, violation(), violation(date="soon"), "", violation(county="ZZ"), violation(street='"BROADWAY ""N"", X"')]
    b = [header, violation(date="1/5/1999"), violation(house="bad!"), violation(street=""), "cut,line", violation()]
    write(f"{tmp_dir}/v/a.csv", a)
    write(f"{tmp_dir}/v/b.csv", b)
    got = {(os.path.basename(r["file"]), r["record"]): (r["raw"], r["reason"])
           for r in rejects.violation_rejects(spark, f"{tmp_dir}/v", YEARS).collect()}
    assert got == {("a.csv", 1): (a[2], "date"), ("a.csv", 2): (a[4], "county"),
                   ("b.csv", 0): (b[1], "year"), ("b.csv", 1): (b[2], "house"),
                   ("b.csv", 2): (b[3], "street"), ("b.csv", 3): (b[4], "date")}
    lines = rejects.read_lines(spark, f"{tmp_dir}/v", header=True)
    tagged = rejects.tag_records(lines, files.VIOLATION_POSITIONS, rejects.violation_rules(YEARS))
    clean = tagged.where("reason IS NULL")
    assert clean.count() + len(got) == files.read_violations(spark, f"{tmp_dir}/v").count() == 4 + 5
    assert 'BROADWAY "N", X' in {r["street_name"] for r in clean.collect()}


def test_record_numbers_go_on_across_splits(spark, tmp_dir):
    lines = ["header"] + [violation(house="bad!" if i % 97 == 0 else "7") for i in range(5000)]
    write(f"{tmp_dir}/v.csv", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert rejects.read_lines(spark, f"{tmp_dir}/v.csv", header=True).select("block").distinct().count() > 5
        got = rejects.violation_rejects(spark, f"{tmp_dir}/v.csv", YEARS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["record"] for r in got) == list(range(0, 5000, 97))


def test_trip_and_tweet_rejects(spark, tmp_dir):
    def trip(lon="-73.9", drop="40.7"):
        cols = ["0"] * 11
        cols[5], cols[10] = lon, drop
        return ",".join(cols)

    write(f"{tmp_dir}/t.csv", ["header", trip(), trip(lon="west"), trip(drop="")])
    all_four = rejects.trip_rejects(spark, f"{tmp_dir}/t.csv").collect()
    assert {(r["record"], r["reason"]) for r in all_four} == {(1, "pickup_lon"), (2, "dropoff_lat")}
    pickup = rejects.trip_rejects(spark, f"{tmp_dir}/t.csv", positions=rejects.PICKUP_POSITIONS)
    assert [(r["reason"], r["n"]) for r in rejects.reject_counts(pickup).collect()] == [("pickup_lon", 1)]
    write(f"{tmp_dir}/p.txt", ['id|40.7|-73.9|a|b|c|"the, oxy" here', "id|x|-73|a|b|c|t", "id|40.7|-73.9|a|b|c"])
    got = {(r["record"], r["reason"]) for r in rejects.tweet_rejects(spark, f"{tmp_dir}/p.txt").collect()}
    assert got == {(1, "lat"), (2, "text")}


def test_empty_input_has_no_rejects(spark, tmp_dir):
    write(f"{tmp_dir}/e/empty.csv", ["header"])
    assert rejects.violation_rejects(spark, f"{tmp_dir}/e", YEARS).collect() == []


def test_cli_writes_rejects_beside_the_result(spark, tmp_dir):
    import json
    square = {"type": "Feature", "properties": {"boro_name": "B"},
              "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}}
    write(f"{tmp_dir}/z.geojson", [json.dumps({"type": "FeatureCollection", "features": [square]})])
    good, bad = ["0"] * 11, ["0"] * 11
    good[5] = good[6] = "1"
    bad[6] = "?"
    write(f"{tmp_dir}/t.csv", ["header", ",".join(good), ",".join(bad)])
    cli.main(["--rejects", f"{tmp_dir}/rejects", "zone-count", f"{tmp_dir}/t.csv", f"{tmp_dir}/z.geojson"], spark)
    kept = spark.read.parquet(f"{tmp_dir}/rejects").collect()
    assert [(r["record"], r["reason"], r["raw"]) for r in kept] == [(1, "pickup_lat", ",".join(bad))]
