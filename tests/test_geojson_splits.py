"""The partitioned GeoJSON reader gives the rows of the whole-file reader, however the file is split."""

import json

import pytest

from blockwise.plans import cli
from blockwise.sources import files, geojson

ODD_NAMES = ['plain', 'a } b { c', 'quote \\" } "', '\\', '\\\\"}{', '},{"type":"Feature"', 'Zürich ]}', '[[', '', '{"a":{}}']


def feature(i):
    x = i * 10.0
    ring = [[x, 0], [x + 4, 0], [x + 4, 4], [x, 4], [x, 0]]
    hole = [[x + 1, 1], [x + 2, 1], [x + 2, 2], [x + 1, 1]]
    geometry = ({"type": "Polygon", "coordinates": [ring, hole]} if i % 3 else
                {"type": "MultiPolygon", "coordinates": [[ring, hole], [[[x, 5], [x + 1, 5], [x, 6], [x, 5]]]]})
    properties = {"name": ODD_NAMES[i % len(ODD_NAMES)], "n": i, "deep": {"a": [{"b": "}"}, {}]}}
    parts = {"type": "Feature", "properties": properties, "geometry": geometry}
    if i % 4 == 0:
        parts = {"geometry": geometry, "bbox": [0, 1], "properties": properties, "type": "Feature"}
    return parts


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("split_bytes", [100, 777, 1 << 20])
def test_split_reader_equals_whole_reader(spark, tmp_dir, indent, split_bytes):
    layers = {"a": {"type": "FeatureCollection", "name": 'x } { "', "crs": {"type": "name", "properties": {"name": "}"}},
                    "bbox": [[1, {"z": 2}]][0][:1], "features": [feature(i) for i in range(40)], "after": {"k": "}"}},
              "b": {"features": [feature(i) for i in range(5)], "type": "FeatureCollection"},
              "c": {"type": "FeatureCollection", "features": []}}
    for name, layer in layers.items():
        with open(f"{tmp_dir}/{name}.geojson", "w") as fh:
            fh.write(json.dumps(layer, indent=indent, ensure_ascii=False) + "\n" * (name == "b"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        splits = geojson.read_pieces(spark, f"{tmp_dir}/a.geojson").select("block").distinct().count()
        got = geojson.read_geojson_rings(spark, tmp_dir, ["name", "n"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert splits > 5 or split_bytes > 1000
    want = files.read_geojson_rings(spark, tmp_dir, ["name", "n"]).collect()
    assert len(want) == 45
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_cli_reads_layers_by_splits(spark, tmp_dir, capsys):
    with open(f"{tmp_dir}/z.geojson", "w") as fh:
        json.dump({"type": "FeatureCollection", "features": [feature(1), feature(2)]}, fh)
    row = ["0"] * 11
    row[5], row[6] = "13", "3"
    with open(f"{tmp_dir}/t.csv", "w") as fh:
        fh.write("header\n" + ",".join(row) + "\n")
    cli.main(["--split-layers", "zone-count", f"{tmp_dir}/t.csv", f"{tmp_dir}/z.geojson", "--zone-attr", "name"], spark)
    assert "a } b { c,1" in capsys.readouterr().out
