"""Zone counts over a file stream equal the batch job on the same files."""

import os

from blockwise.operators.spatial import ZoneIndex
from blockwise.plans.jobs import zone_count
from blockwise.sources import files
from blockwise.streaming import running_zone_counts, start_zone_counts, trip_stream

EDGE_SCHEMA = "zone_id long, zone_name string, x1 double, y1 double, x2 double, y2 double"
SQUARES = {"west": (0.0, 0.0), "east": (2.0, 0.0)}


def _edges():
    rows = []
    for i, (name, (x, y)) in enumerate(sorted(SQUARES.items())):
        ring = [(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2)]
        rows += [(i, name, *ring[k], *ring[(k + 1) % 4]) for k in range(4)]
    return rows


def test_stream_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/trips"
    os.makedirs(src)
    for f in range(3):
        with open(f"{src}/part{f}.csv", "w") as fh:
            fh.write("c0,c1,c2,c3,c4,c5,c6\n")
            for k in range(20):
                fh.write(f"0,0,0,0,0,{(k * 7 + f) % 40 / 10.0},{(k * 3) % 20 / 10.0}\n")
    idx = ZoneIndex(spark.createDataFrame(_edges(), EDGE_SCHEMA))
    cols = {5: "x", 6: "y"}
    q = start_zone_counts(running_zone_counts(trip_stream(spark, src, columns=cols, max_files_per_trigger=1),
                                              idx, x="x", y="y"),
                          checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    streamed = {r["zone_name"]: r["n"] for r in spark.sql("SELECT * FROM zone_counts").collect()}
    batch_pts = files.read_trips(spark, src, positions=cols)
    batch = {r["zone_name"]: r["n"] for r in zone_count(batch_pts, idx, x="x", y="y").collect()}
    assert streamed == batch and sum(batch.values()) > 0


def test_restart_from_checkpoint_counts_each_file_once(spark, tmp_dir):
    src = f"{tmp_dir}/trips2"
    os.makedirs(src)

    def add_file(f):
        with open(f"{src}/part{f}.csv", "w") as fh:
            fh.write("c0,c1,c2,c3,c4,c5,c6\n")
            for k in range(15):
                fh.write(f"0,0,0,0,0,{(k * 11 + f) % 40 / 10.0},{(k * 7) % 20 / 10.0}\n")

    idx = ZoneIndex(spark.createDataFrame(_edges(), EDGE_SCHEMA))
    cols = {5: "x", 6: "y"}
    ckpt = f"{tmp_dir}/ckpt2"

    def run():
        q = start_zone_counts(running_zone_counts(trip_stream(spark, src, columns=cols), idx,
                                                  x="x", y="y"), checkpoint=ckpt)
        q.awaitTermination(120)
        return {r["zone_name"]: r["n"] for r in spark.sql("SELECT * FROM zone_counts").collect()}

    add_file(0)
    add_file(1)
    first = run()
    add_file(2)
    second = run()          # a new query on the same checkpoint: state restored
    batch = {r["zone_name"]: r["n"] for r in
             zone_count(files.read_trips(spark, src, positions=cols), idx, x="x", y="y").collect()}
    assert second == batch and sum(second.values()) > sum(first.values())
