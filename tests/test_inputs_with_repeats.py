"""Inputs with repeated rows, missing names, several files and odd dates."""

import json

import pytest

from blockwise import sinks
from blockwise.functions import normalize as N
from blockwise.operators import range_join as RJ
from blockwise.operators.spatial import ZoneIndex, choose_cell_size, edges_from_rings
from blockwise.plans import jobs
from blockwise.sources import files

RECORD = "street_name string, county string, house_no string, issue_date string"
SEGMENT = ("physical_id string, st_name string, full_street string, borough int, "
           "l_low string, l_high string, r_low string, r_high string")


def test_repeated_centerline_rows_count_once(spark):
    records = spark.createDataFrame([("MAIN ST", "NY", "11", "1/5/2017")], RECORD)
    row = ("1", "Main St", "Main Street", 1, "1", "99", "2", "98")
    segments = spark.createDataFrame([row, row], SEGMENT)
    cols = {"date": "issue_date", "year": None}
    for keep in RJ.KEEP_MODES:
        out = jobs.segment_trend(records, segments, [2015, 2016, 2017, 2018, 2019], record_cols=cols, keep=keep)
        assert [r["count_2017"] for r in out.where("physical_id IS NOT NULL").collect()] == [1]


def test_dates_of_several_shapes(spark):
    texts = ["1/5/2017", "2017-01-05", "01/05/2017 10:00:00", "Jan 5 2017", "13/45/2017", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    assert [r[0] for r in df.select(N.year_lenient("d")).collect()] == [2017] * 4 + [None] * 3
    assert RJ.count_bad_dates(df, "d").first().asDict() == {"n": 7, "n_bad": 3}


def _square(name, x, size=1.0):
    ring = [[x, 0.0], [x + size, 0.0], [x + size, size], [x, size], [x, 0.0]]
    return {"type": "Feature", "properties": {"name": name, "pop": "10"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def _write(folder, name, features):
    (folder / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}))


def test_layer_in_several_files(spark, tmp_path):
    _write(tmp_path, "a.geojson", [_square("z0", 0.0), _square("z1", 2.0)])
    _write(tmp_path, "b.geojson", [_square("z10", 10.0)])
    index = ZoneIndex(files.read_geojson_edges(spark, str(tmp_path), ["name"]), attrs=("name",))
    points = spark.createDataFrame([(0.5, 0.5), (2.5, 0.5), (10.5, 0.5), (5.0, 0.5)], "x double, y double")
    found = index.assign(points, x="x", y="y", how="inner", carry=("name",)).select("x", "name").collect()
    assert {(r["x"], r["name"]) for r in found} == {(0.5, "z0"), (2.5, "z1"), (10.5, "z10")}


def test_tract_of_two_features_gives_one_line(spark, tmp_path):
    _write(tmp_path, "t.geojson", [_square("t1", 0.0), _square("t1", 2.0)])
    rings = files.read_geojson_rings(spark, str(tmp_path / "t.geojson"), ["name", "pop"])
    zones = ZoneIndex(edges_from_rings(rings, attrs=["name"]), attrs=("name",))
    posts = spark.createDataFrame([("a b", 0.5, 0.5), ("b", 2.5, 0.5), ("c", 2.5, 0.5)], "text string, x double, y double")
    population = rings.selectExpr("zone_id", "cast(pop AS double) AS population")
    rates = jobs.keyword_rate(posts, zones, population, ["b"])
    merged = jobs.merge_zones(rates, rings.selectExpr("zone_id", "name AS tract"))
    assert [(r["tract"], r["n"], r["rate"]) for r in merged.collect()] == [("t1", 2, 0.2)]


def test_unnamed_zones_take_no_rank(spark):
    def layer(names):
        rows = [(i, [[(x + i * 2.0, y) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))]], n) for i, n in enumerate(names)]
        rings = spark.createDataFrame(rows, "zone_id long, rings array<array<struct<x:double,y:double>>>, zone_name string")
        return ZoneIndex(edges_from_rings(rings, attrs=["zone_name"]))

    boroughs, areas = layer(["B", None]), layer([None, "n1", "n2", "n3"])
    trips = [(0.5, 0.5, 0.5 + 2 * area, 0.5) for area, n in ((0, 10), (1, 9), (2, 8), (3, 7)) for _ in range(n)]
    trips += [(2.5, 0.5, 2.5, 0.5)]
    lines = jobs.zone_pair_lines(spark.createDataFrame(trips, "px double, py double, dx double, dy double"), boroughs, areas)
    assert [r["line"] for r in lines.collect()] == ["B,[('n1', 9), ('n2', 8), ('n3', 7)]"]


@pytest.mark.parametrize("n", [1, 499_990, 500_001, 1_000_000])
def test_grid_step_for_many_unit_zones(n):
    stats = {"n": n, "area": float(n), "perim": 2.0 * n, "max_w": 1.0, "max_h": 1.0, "A": 5.0 * n, "B": 10.0 * n, "C": 5 * n}
    step = choose_cell_size(stats, broadcast_rows=1_000_000)
    assert 0 < step <= 0.5  # at most a few unit zones meet in a cell


def test_existing_output_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "line string")
    sinks.write_lines(df, "line", str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_lines(df, "line", str(tmp_path / "out"))
