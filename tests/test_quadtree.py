"""Leaves of several sizes, scanline parity and weighted points against the plain even-odd test."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockwise.operators.quadtree import QuadIndex, zone_index
from blockwise.operators.spatial import ZoneIndex
from blockwise.plans import jobs
from blockwise.scratch import shared_folder

from test_spatial import EDGE_SCHEMA, EDGES, POINTS, brute_zone, ring_edges


def star(rng, cx, cy, radius, n, least=0.2):
    """A closed ring around (cx, cy), of uneven radius."""
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(cx + radius * rng.uniform(least, 1) * math.cos(t), cy + radius * rng.uniform(least, 1) * math.sin(t)) for t in turns]


def mixed_layer(blocks=12, seed=1):
    """One polygon around a grid of small blocks, some of them on each other's borders."""
    rng, edges = random.Random(seed), []
    for i in range(blocks):
        for j in range(blocks):
            x, y = 10 + i * 0.5, 10 + j * 0.5
            edges += ring_edges(1 + i * blocks + j, f"b{i}.{j}", [(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5)])
    return edges + ring_edges(100_000, "land", star(rng, 13, 13, 60, 200))


def points_for(edges, rng, n):
    corners = [(x, y) for _, _, x, y, _, _ in edges]
    near = [(x + rng.choice([0, 0, 1e-9, -1e-9, 0.25]), y + rng.choice([0, 0, 1e-9, 0.25])) for x, y in rng.choices(corners, k=n // 2)]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    far = [(rng.uniform(min(xs) - 1, max(xs) + 1), rng.uniform(min(ys) - 1, max(ys) + 1)) for _ in range(n - len(near))]
    return [(i, x, y) for i, (x, y) in enumerate(near + far)]


def assigned(spark, index, pts, how="left"):
    frame = spark.createDataFrame(pts, "pid int, x double, y double")
    return {r["pid"]: r["zone_id"] for r in index.assign(frame, x="x", y="y", how=how).collect()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_edge_cases(spark, broadcast):
    index = QuadIndex(spark.createDataFrame(EDGES, EDGE_SCHEMA), max_edges=2, max_level=3, broadcast=broadcast)
    pts = spark.createDataFrame(POINTS, "pid int, x double, y double")
    got = {r["pid"]: (r["zone_id"], r["zone_name"]) for r in index.assign(pts, x="x", y="y", carry=("zone_name",)).collect()}
    assert got == {1: (1, "holed"), 2: (None, None), 3: (2, "multi"), 4: (None, None), 5: (None, None), 6: (1, "holed"),
                   7: (None, None), 8: (None, None), 9: (3, "over"), 10: (None, None), 11: (None, None)}
    inner = index.assign(pts, x="x", y="y", how="inner", match="all").collect()
    assert sorted((r["pid"], r["zone_id"]) for r in inner) == [(1, 1), (3, 2), (6, 1), (6, 3), (9, 3)]


def test_mixed_layer_equals_the_plain_test(spark):
    edges = mixed_layer()
    pts = points_for(edges, random.Random(4), 1_200)
    index = QuadIndex(spark.createDataFrame(edges, EDGE_SCHEMA), max_edges=16)
    assert len(index.levels) > 2
    want = {i: brute_zone(edges, x, y) for i, x, y in pts}
    assert assigned(spark, index, pts) == want
    sizes = index.cells.select(F.aggregate("_zones", F.lit(0), lambda n, z: n + F.size(z["edges"])).alias("n")).agg(F.max("n")).first()[0]
    assert sizes <= index.max_edges


@settings(max_examples=2, deadline=None)
@given(st.integers(0, 10_000))
def test_random_layers(spark, seed):
    rng, edges = random.Random(seed), []
    offset = rng.choice([0.0, -1_000.0, 9.9e5])
    for z in range(rng.randint(1, 12)):
        size = 10 ** rng.uniform(-2, 2)
        ring = star(rng, offset + rng.uniform(0, 20), rng.uniform(0, 20), size, rng.randint(3, 40))
        edges += ring_edges(z, f"z{z}", [(round(x, 1), round(y, 1)) for x, y in ring] if rng.random() < 0.5 else ring)
    edges = [e for e in edges if e[2:4] != e[4:6]]
    pts = points_for(edges, rng, 150) if edges else []
    if not pts:
        return
    frame = spark.createDataFrame(edges, EDGE_SCHEMA)
    want = {i: brute_zone(edges, x, y) for i, x, y in pts}
    assert assigned(spark, QuadIndex(frame, max_edges=rng.choice([1, 4, 16]), max_level=3), pts) == want
    assert assigned(spark, ZoneIndex(frame, cell_size=rng.choice([None, 0.7, 9.0])), pts) == want


def test_one_polygon_of_many_edges(spark):
    """No group of the build holds a zone's edges: they are gathered by cell alone."""
    edges = ring_edges(7, "coast", star(random.Random(9), 0, 0, 100, 6_000, 0.97))
    pts = points_for(edges, random.Random(5), 120)
    frame = spark.createDataFrame(edges, EDGE_SCHEMA)
    want = {i: brute_zone(edges, x, y) for i, x, y in pts}
    grid = ZoneIndex(frame)
    assert assigned(spark, grid, pts) == want and assigned(spark, QuadIndex(frame), pts) == want
    longest = grid.cells.select(F.max(F.aggregate("_zones", F.lit(0), lambda n, z: n + F.size(z["edges"])))).first()[0]
    assert longest < len(edges) / 10
    text = grid.cells._jdf.queryExecution().optimizedPlan().toString()
    gathered = [line for line in text.splitlines() if "collect_list" in line and "Aggregate" in line]
    assert gathered and all("gx" in line.split("[", 1)[1].split("]", 1)[0] for line in gathered)


def test_the_index_follows_the_layer(spark):
    small = spark.createDataFrame(EDGES, EDGE_SCHEMA)
    assert type(zone_index(small)) is ZoneIndex
    mixed = spark.createDataFrame(mixed_layer(), EDGE_SCHEMA)
    index = zone_index(mixed, broadcast_rows=20_000)
    assert type(index) is QuadIndex and index.is_broadcast and index.cell_stats()["entries"] <= 20_000
    assert QuadIndex(mixed.limit(0)).assign(spark.createDataFrame(POINTS, "pid int, x double, y double"), x="x", y="y").count() == len(POINTS)


# -- weights ------------------------------------------------------------------

def hot_points(spark):
    """A third of all points on one coordinate."""
    p = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0.5D ELSE (id * 37 % 900) / 100D END AS x",
                                    "CASE WHEN id % 3 = 0 THEN 0.5D ELSE (id * 91 % 700) / 100D END AS y")
    return p.selectExpr("*", "CASE WHEN id % 2 = 0 THEN 3.75D ELSE x / 2 END AS dx", "CASE WHEN id % 2 = 0 THEN 3.75D ELSE y END AS dy",
                        "CASE WHEN id % 5 < 3 THEN 'a word' ELSE 'other' END AS text")


@pytest.mark.parametrize("form", [ZoneIndex, QuadIndex])
def test_counting_jobs_count_a_coordinate_once(spark, form):
    edges, pts = spark.createDataFrame(EDGES, EDGE_SCHEMA), hot_points(spark)
    here, apart = form(edges, broadcast=True), form(edges, broadcast=False)
    people = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "zone_id long, population long")

    def both(job):
        frames = [job(ix) for ix in (here, apart)]
        rows = [sorted(map(tuple, f.collect())) for f in frames]
        assert rows[0] == rows[1] and rows[0]
        return frames

    plain, split = both(lambda ix: jobs.zone_count(pts, ix, x="x", y="y"))
    both(lambda ix: jobs.keyword_rate(pts, ix, people, ["word"]))
    both(lambda ix: jobs.zone_pairs(pts, ix, ix, pickup=("x", "y")))
    plan = [f._jdf.queryExecution().optimizedPlan().toString() for f in (plain, split)]
    assert "Aggregate [x#" not in plan[0] and "Aggregate [x#" in plan[1]
    counted = jobs.zone_count(pts, apart, x="x", y="y").agg(F.sum("n")).first()[0]
    assert counted == here.assign(pts, x="x", y="y", how="inner").count()


def test_a_shared_folder_is_named_off_one_machine(spark, monkeypatch):
    assert shared_folder(spark)

    class Elsewhere:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: type("C", (), {"get": lambda self, k, d: d})())
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Elsewhere()
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})()

    with pytest.raises(ValueError):
        shared_folder(Session())
