"""Command-line entry points for the four jobs (S8: paths chosen by the caller).

    python -m blockwise.plans.cli segment-trend VIOLATIONS CENTERLINE OUT [--years 2015 2019]
    python -m blockwise.plans.cli zone-pairs TRIPS BOROUGHS NEIGHBORHOODS OUT
    python -m blockwise.plans.cli keyword-rate TWEETS TRACTS OUT --terms LIST [LIST ...] \
        --tract-attr ID --population-attr POP
    python -m blockwise.plans.cli zone-count TRIPS ZONES [--swap-xy]

Inputs are the raw files (directories allowed); polygon layers are GeoJSON.
``--rejects OUT`` also writes the rows that a job cannot read, with file, record and reason.
``--split-layers`` reads each polygon layer by many tasks, for layers beyond one task's memory.
``--project`` reprojects lon/lat layers and points to EPSG:2263 feet first.
Results are written by the executors (CSV or text lines); the zone count,
a handful of rows, is printed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from blockwise import sinks
from blockwise.operators.spatial import ZoneIndex, project_edges, project_points
from blockwise.plans import jobs
from blockwise.session import get_session
from blockwise.sources import files, geojson, rejects


def _layer(spark, path, attr, project, split=False):
    source = geojson if split else files
    e = source.read_geojson_edges(spark, path, [attr]).withColumnRenamed(attr, "zone_name")
    return project_edges(e) if project else e


def _points(df, lon, lat, x, y, project):
    if project:
        return project_points(df, lon, lat, x=x, y=y)
    return df.withColumn(x, F.col(lon)).withColumn(y, F.col(lat))


def _keep_rejects(spark: SparkSession, a) -> None:
    """The dropped rows of a job's records, beside its result."""
    if a.job == "segment-trend":
        years = range(a.years[0], a.years[1] + 1)
        rejected = rejects.violation_rejects(spark, a.violations, years, mode=a.mode)
    elif a.job == "keyword-rate":
        rejected = rejects.tweet_rejects(spark, a.tweets)
    else:
        positions = files.TRIP_POSITIONS if a.job == "zone-pairs" else rejects.PICKUP_POSITIONS
        rejected = rejects.trip_rejects(spark, a.trips, positions=positions)
    sinks.write_rejects(rejected, a.rejects)


def segment_trend(spark: SparkSession, a) -> None:
    years = list(range(a.years[0], a.years[1] + 1))
    out = jobs.segment_trend(files.read_violations(spark, a.violations),
                             files.read_centerline(spark, a.centerline), years,
                             record_cols={"date": "issue_date", "year": None},
                             mode=a.mode, keep=a.keep)
    sinks.write_csv(out.orderBy("physical_id"), a.out)


def zone_pairs(spark: SparkSession, a) -> None:
    ix = ZoneIndex.build_many({"b": _layer(spark, a.boroughs, a.borough_attr, a.project, a.split_layers),
                               "n": _layer(spark, a.neighborhoods, a.neighborhood_attr, a.project, a.split_layers)})
    t = files.read_trips(spark, a.trips)
    t = _points(t, "pickup_lon", "pickup_lat", "px", "py", a.project)
    t = _points(t, "dropoff_lon", "dropoff_lat", "dx", "dy", a.project)
    sinks.write_lines(jobs.zone_pair_lines(t, ix["b"], ix["n"], k=a.k), "line", a.out)


def keyword_rate(spark: SparkSession, a) -> None:
    rings = (geojson if a.split_layers else files).read_geojson_rings(spark, a.tracts, [a.tract_attr, a.population_attr])
    population = rings.select("zone_id", F.col(a.population_attr).try_cast("double")
                              .alias("population"))
    zones = ZoneIndex(_layer(spark, a.tracts, a.tract_attr, a.project, a.split_layers))
    posts = _points(files.read_tweets(spark, a.tweets), "lon", "lat", "x", "y", a.project)
    rates = jobs.keyword_rate(posts, zones, population, files.read_word_lists(spark, a.terms))
    # A tract may be stored as several features: one line per tract and population.
    keyed = jobs.merge_zones(rates, rings.select("zone_id", F.col(a.tract_attr).alias("tract")))
    sinks.write_lines(jobs.keyword_rate_lines(keyed, key="tract"), "line", a.out)


def zone_count(spark: SparkSession, a) -> None:
    lon, lat = ("pickup_lat", "pickup_lon") if a.swap_xy else ("pickup_lon", "pickup_lat")
    pts = _points(files.read_trips(spark, a.trips), lon, lat, "x", "y", a.project)
    zones = ZoneIndex(_layer(spark, a.zones, a.zone_attr, a.project, a.split_layers))
    for r in jobs.zone_count(pts, zones, x="x", y="y").orderBy("zone_name").collect():
        print(f"{r['zone_name']},{r['n']}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blockwise")
    p.add_argument("--master", default=None, help="Spark master (default: the cluster's)")
    p.add_argument("--project", action="store_true", help="reproject lon/lat to EPSG:2263")
    p.add_argument("--split-layers", action="store_true", help="read each GeoJSON file by many tasks")
    p.add_argument("--rejects", default=None, help="folder for the rows that cannot be read")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("segment-trend")
    s.add_argument("violations"), s.add_argument("centerline"), s.add_argument("out")
    s.add_argument("--years", nargs=2, type=int, default=[2015, 2019])
    s.add_argument("--mode", default="pair", choices=["pair", "concat_text", "concat_int"])
    s.add_argument("--keep", default="matched", choices=["matched", "records", "segments"])
    z = sub.add_parser("zone-pairs")
    z.add_argument("trips"), z.add_argument("boroughs"), z.add_argument("neighborhoods")
    z.add_argument("out"), z.add_argument("--k", type=int, default=3)
    z.add_argument("--borough-attr", default="boroname")
    z.add_argument("--neighborhood-attr", default="neighborhood")
    k = sub.add_parser("keyword-rate")
    k.add_argument("tweets"), k.add_argument("tracts"), k.add_argument("out")
    k.add_argument("--terms", nargs="+", required=True, help="word-list files")
    k.add_argument("--tract-attr", required=True, help="feature property holding the tract id")
    k.add_argument("--population-attr", required=True, help="feature property holding population")
    c = sub.add_parser("zone-count")
    c.add_argument("trips"), c.add_argument("zones")
    c.add_argument("--zone-attr", default="boro_name")
    c.add_argument("--swap-xy", action="store_true", help="read the point columns swapped")
    return p


RUNNERS = {"segment-trend": segment_trend, "zone-pairs": zone_pairs,
           "keyword-rate": keyword_rate, "zone-count": zone_count}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if spark is None:
        spark = get_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    RUNNERS[a.job](spark, a)
    if a.rejects:
        _keep_rejects(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
