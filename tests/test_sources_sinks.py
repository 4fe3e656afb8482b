"""File sources (S1-S7) and sinks (K1, K2) on hand-made files."""

import os

from pyspark.sql import functions as F

from blockwise import sinks
from blockwise.operators.keywords import keyword_filter
from blockwise.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def violation_line(date, county, house, street, extra='x'):
    cols = [extra] * 25
    cols[4], cols[21], cols[23], cols[24] = date, county, house, street
    return ",".join(cols)


def test_violations_directory_headers_and_quotes(spark, tmp_dir):
    header = ",".join(f"h{i}" for i in range(25))
    d = f"{tmp_dir}/violations"
    _write(f"{d}/part1.csv", header + "\n" + violation_line("01/05/2017", "NY", "12-05", "main st") + "\n")
    _write(f"{d}/part2.csv", header + "\n" + violation_line("1/5/2018", "BX", "7", '"BROADWAY ""N"", X"') + "\n"
           + violation_line("13/45/2017", "ZZ", "", "ELM") + "\n")
    df = files.read_violations(spark, d)
    rows = sorted(tuple(r) for r in df.collect())
    assert len(rows) == 3  # both headers dropped
    assert ("1/5/2018", "BX", "7", 'BROADWAY "N", X') in rows


def test_centerline_types(spark, tmp_dir):
    cols = ["0"] * 30
    cols[0], cols[2], cols[3], cols[4], cols[5], cols[13], cols[28], cols[29] = \
        "17", "1", "99", "2", "98", "3", "MAIN STREET", "MAIN ST"
    header = ",".join(f"h{i}" for i in range(30))
    _write(f"{tmp_dir}/cl.csv", header + "\n" + ",".join(cols) + "\nbad," + ",".join(["x"] * 29) + "\n")
    rows = files.read_centerline(spark, f"{tmp_dir}/cl.csv").orderBy("physical_id").collect()
    assert rows[0]["physical_id"] is None and rows[0]["borough"] is None
    assert (rows[1]["physical_id"], rows[1]["borough"], rows[1]["st_name"]) == (17, 3, "MAIN ST")


def test_trips_and_tweets(spark, tmp_dir):
    trip = ["0"] * 11
    trip[5], trip[6], trip[9], trip[10] = "-73.98", "40.75", "oops", "40.70"
    _write(f"{tmp_dir}/trips.csv", "header\n" + ",".join(trip) + "\n")
    t = files.read_trips(spark, f"{tmp_dir}/trips.csv").first()
    assert t["pickup_lon"] == -73.98 and t["dropoff_lon"] is None
    _write(f"{tmp_dir}/tweets.txt", 'id|40.7|-73.9|a|b|c|"the oxy" here|z\nid|x|y|a|b|c|none\n')
    tw = files.read_tweets(spark, f"{tmp_dir}/tweets.txt").collect()
    assert tw[0]["text"] == '"the oxy" here' and tw[0]["lat"] == 40.7 and tw[1]["lat"] is None


def test_word_lists(spark, tmp_dir):
    _write(f"{tmp_dir}/w1.txt", "oxy\n Heroin\n")
    _write(f"{tmp_dir}/w2.txt", "crack\n")
    terms = files.read_word_lists(spark, [f"{tmp_dir}/w1.txt", f"{tmp_dir}/w2.txt"])
    assert sorted(r["term"] for r in terms.collect()) == [" Heroin", "crack", "oxy"]
    posts = spark.createDataFrame([(1, "some crack"), (2, "Heroin x")], "id int, text string")
    assert [r["id"] for r in keyword_filter(posts, "text", terms).collect()] == [1]


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.5), (2, 0.0)], "physical_id long, ols_coeff double")
    sinks.write_csv(df.orderBy("physical_id").coalesce(1), f"{tmp_dir}/out_csv")
    back = spark.read.csv(f"{tmp_dir}/out_csv", schema="a long, b double").orderBy("a").collect()
    assert [tuple(r) for r in back] == [(1, 2.5), (2, 0.0)]
    lines = df.select(F.concat_ws(",", "physical_id", "ols_coeff").alias("line"))
    sinks.write_lines(lines, "line", f"{tmp_dir}/out_txt")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/out_txt").collect()) == ["1,2.5", "2,0.0"]


def test_segment_trend_from_files(spark, tmp_dir):
    from blockwise.plans.jobs import segment_trend
    header = ",".join(f"h{i}" for i in range(25))
    lines = [violation_line("03/01/2015", "NY", "7", "main st"),
             violation_line("1/2/2019", "MN", "9", "MAIN ST"),
             violation_line("1/2/2019", "MN", "8", "MAIN ST"),      # even: right side
             violation_line("1/2/2013", "MN", "9", "MAIN ST"),      # outside the window
             violation_line("1/2/2019", "MN", "9A", "MAIN ST")]     # malformed number
    _write(f"{tmp_dir}/v/a.csv", header + "\n" + "\n".join(lines[:3]) + "\n")
    _write(f"{tmp_dir}/v/b.csv", header + "\n" + "\n".join(lines[3:]) + "\n")
    cols = ["0"] * 30
    cols[0], cols[2], cols[3], cols[4], cols[5], cols[13], cols[28], cols[29] = \
        "17", "1", "99", "2", "98", "1", "MAIN STREET", "MAIN ST"
    _write(f"{tmp_dir}/cl.csv", ",".join(f"h{i}" for i in range(30)) + "\n" + ",".join(cols) + "\n")
    v = files.read_violations(spark, f"{tmp_dir}/v")
    c = files.read_centerline(spark, f"{tmp_dir}/cl.csv")
    out = segment_trend(v, c, [2015, 2016, 2017, 2018, 2019],
                        record_cols={"date": "issue_date", "year": None}).collect()
    assert [(r["physical_id"], r["count_2015"], r["count_2019"], r["ols_coeff"]) for r in out] == \
        [(17, 1, 2, (-2 * 1 + 2 * 2) / 10)]
    from blockwise.plans import cli
    cli.main(["segment-trend", f"{tmp_dir}/v", f"{tmp_dir}/cl.csv", f"{tmp_dir}/out_trend"],
             spark=spark)
    lines = [r[0] for r in spark.read.text(f"{tmp_dir}/out_trend").collect()]
    assert lines == ["17,1,0,0,0,2,0.2"]


def test_zone_pair_lines_from_files(spark, tmp_dir):
    """The README path: GeoJSON layers + trip CSV, projected, to text lines."""
    import json
    from blockwise.operators.spatial import ZoneIndex, project_edges, project_points
    from blockwise.plans.jobs import zone_pair_lines

    def square(x0, y0, d):
        return [[x0, y0], [x0 + d, y0], [x0 + d, y0 + d], [x0, y0 + d], [x0, y0]]
    boroughs = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"boroname": "Manhattan"},
         "geometry": {"type": "Polygon", "coordinates": [square(-74.02, 40.70, 0.1)]}}]}
    hoods = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"neighborhood": name},
         "geometry": {"type": "Polygon", "coordinates": [square(-74.02 + 0.05 * i, 40.70, 0.05)]}}
        for i, name in enumerate(["Midtown", "Harlem"])]}
    for name, fc in (("boroughs", boroughs), ("neighborhoods", hoods)):
        with open(f"{tmp_dir}/{name}.geojson", "w") as fh:
            json.dump(fc, fh)
    rows = [(-73.99, 40.75, -74.00, 40.72)] * 3 + [(-73.99, 40.75, -73.95, 40.72)] * 2 + \
           [(-73.99, 40.75, -75.0, 40.0)]
    lines = ["h" + ",h" * 10]
    for plon, plat, dlon, dlat in rows:
        cols = ["0"] * 11
        cols[5], cols[6], cols[9], cols[10] = map(str, (plon, plat, dlon, dlat))
        lines.append(",".join(cols))
    _write(f"{tmp_dir}/trips/a.csv", "\n".join(lines) + "\n")
    layers = {n: project_edges(files.read_geojson_edges(spark, f"{tmp_dir}/{n}.geojson", [a])
                               .withColumnRenamed(a, "zone_name"))
              for n, a in (("boroughs", "boroname"), ("neighborhoods", "neighborhood"))}
    ix = ZoneIndex.build_many(layers)
    trips = files.read_trips(spark, f"{tmp_dir}/trips")
    trips = project_points(trips, "pickup_lon", "pickup_lat", x="px", y="py")
    trips = project_points(trips, "dropoff_lon", "dropoff_lat", x="dx", y="dy")
    out = zone_pair_lines(trips, ix["boroughs"], ix["neighborhoods"]).collect()
    assert [r["line"] for r in out] == ["Manhattan,[('Midtown', 3), ('Harlem', 2)]"]


def test_keyword_rate_from_files(spark, tmp_dir):
    import json
    from blockwise.operators.spatial import ZoneIndex
    from blockwise.plans.jobs import keyword_rate, keyword_rate_lines

    def square(x0, y0, d):
        return [[x0, y0], [x0 + d, y0], [x0 + d, y0 + d], [x0, y0 + d], [x0, y0]]
    tracts = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"tract": "T0", "pop": 4},
         "geometry": {"type": "Polygon", "coordinates": [square(-74.0, 40.7, 0.1)]}},
        {"type": "Feature", "properties": {"tract": "T1", "pop": 0},
         "geometry": {"type": "Polygon", "coordinates": [square(-73.9, 40.7, 0.1)]}}]}
    with open(f"{tmp_dir}/tracts.geojson", "w") as fh:
        json.dump(tracts, fh)
    _write(f"{tmp_dir}/sched2.txt", "oxycodone\nfentanyl\n")
    _write(f"{tmp_dir}/illegal.txt", "heroin\n")
    _write(f"{tmp_dir}/tweets/a.txt", "\n".join([
        "1|40.75|-73.95|x|x|x|got some heroin today",
        "2|40.75|-73.95|x|x|x|nothing here",
        "3|40.75|-73.85|x|x|x|fentanyl again",
        "4|40.75|-73.95|x|x|x|Heroin upper case",
        "5|bad|-73.95|x|x|x|heroin",
    ]) + "\n")
    rings = files.read_geojson_rings(spark, f"{tmp_dir}/tracts.geojson", ["tract", "pop"])
    population = rings.select("zone_id", F.col("pop").try_cast("long").alias("population"))
    zones = ZoneIndex(files.read_geojson_edges(spark, f"{tmp_dir}/tracts.geojson", ["tract"]),
                      attrs=("tract",))
    terms = files.read_word_lists(spark, [f"{tmp_dir}/sched2.txt", f"{tmp_dir}/illegal.txt"])
    posts = files.read_tweets(spark, f"{tmp_dir}/tweets")
    rates = keyword_rate(posts, zones, population, terms, x="lon", y="lat")
    got = {r["zone_id"]: (r["n"], r["rate"]) for r in rates.collect()}
    assert got == {0: (1, 0.25), 1: (1, None)}
    assert [r["line"] for r in keyword_rate_lines(rates).collect()] == ["0,0.25", "1,"]


def test_cli_jobs(spark, tmp_dir, capsys):
    import json
    from blockwise.plans import cli

    def square(x0, y0, d):
        return [[x0, y0], [x0 + d, y0], [x0 + d, y0 + d], [x0, y0 + d], [x0, y0]]

    def layer(path, prop, names):
        fc = {"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {prop: n, "pop": 2},
             "geometry": {"type": "Polygon", "coordinates": [square(-74.02 + 0.05 * i, 40.70, 0.05)]}}
            for i, n in enumerate(names)]}
        with open(path, "w") as fh:
            json.dump(fc, fh)
    layer(f"{tmp_dir}/b.geojson", "boroname", ["West", "East"])
    layer(f"{tmp_dir}/n.geojson", "neighborhood", ["A", "B"])
    rows = ["h" + ",h" * 10]
    for plon, dlon in ((-74.00, -74.00), (-74.00, -73.95), (-73.96, -73.95)):
        cols = ["0"] * 11
        cols[5], cols[6], cols[9], cols[10] = str(plon), "40.72", str(dlon), "40.72"
        rows.append(",".join(cols))
    _write(f"{tmp_dir}/trips/a.csv", "\n".join(rows) + "\n")
    cli.main(["--project", "zone-pairs", f"{tmp_dir}/trips", f"{tmp_dir}/b.geojson",
              f"{tmp_dir}/n.geojson", f"{tmp_dir}/out_pairs"], spark=spark)
    lines = [r[0] for r in spark.read.text(f"{tmp_dir}/out_pairs").collect()]
    assert sorted(lines) == ["East,[('B', 1)]", "West,[('A', 1), ('B', 1)]"]
    cli.main(["zone-count", f"{tmp_dir}/trips", f"{tmp_dir}/b.geojson", "--zone-attr", "boroname"],
             spark=spark)
    assert capsys.readouterr().out.split() == ["East,1", "West,2"]
    _write(f"{tmp_dir}/tw/a.txt", "1|40.72|-74.00|x|x|x|some oxy\n2|40.72|-73.96|x|x|x|none\n")
    _write(f"{tmp_dir}/terms.txt", "oxy\n")
    cli.main(["keyword-rate", f"{tmp_dir}/tw", f"{tmp_dir}/b.geojson", f"{tmp_dir}/out_rate",
              "--terms", f"{tmp_dir}/terms.txt", "--tract-attr", "boroname",
              "--population-attr", "pop"], spark=spark)
    assert [r[0] for r in spark.read.text(f"{tmp_dir}/out_rate").collect()] == ["West,0.5"]
