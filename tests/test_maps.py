from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helpers import bag
from roadpulse.config import ControlPoint
from roadpulse.functions.geo import polygon_rings
from roadpulse.functions.lookup import colour_of
from roadpulse.operators.mapping import map_layer, with_lat_lon, with_point
from roadpulse.sources.geojson import read_collections, read_feature_lines


def scored(spark, rows):
    return spark.createDataFrame(rows, "vehicle_x DOUBLE, vehicle_y DOUBLE, congestion_cluster INT")


def test_worked_position(spark):
    row = with_point(with_lat_lon(scored(spark, [(471.67, 265.37, 4)]))).first()
    assert row.lat == pytest.approx(59.32430234126402, abs=1e-12)
    assert row.lon == pytest.approx(18.075391645208548, abs=1e-12)
    assert row.geometry == f"POINT({row.lon} {row.lat})"


def test_control_points_map_onto_themselves_and_are_parameters(spark):
    row = with_lat_lon(scored(spark, [(0.26, 14.01, 0)])).first()
    assert (row.lat, row.lon) == (59.321926, 18.067417)
    points = (ControlPoint(0.0, 0.0, 10.0, 20.0), ControlPoint(2.0, 4.0, 11.0, 21.0))
    moved = with_lat_lon(scored(spark, [(1.0, 1.0, 0)]), points=points).first()
    assert (moved.lat, moved.lon) == (10.25, 20.5)


def test_colours(spark):
    rows = scored(spark, [(0.0, 0.0, c) for c in (0, 1, 2, 3, 4, 5, None)])
    got = {r.congestion_cluster: r.colour for r in rows.withColumn("colour", colour_of(F.col("congestion_cluster"))).collect()}
    assert got == {0: "gray", 1: "blue", 2: "green", 3: "red", 4: "purple", 5: "gray", None: "gray"}
    assert rows.select(colour_of(F.col("congestion_cluster"), {}, "white").alias("c")).distinct().count() == 1


def test_layer_rows(spark):
    row = map_layer(scored(spark, [(471.67, 265.37, 4)]), colours={4: "black"}).first()
    assert (row.popup, row.colour) == ("Cluster", "black") and set(row.asDict()) == {"lat", "lon", "popup", "colour"}


def feature(name, kind, coordinates):
    return {
        "type": "Feature",
        "properties": {"name": name, "size": 3, "tags": ["a", "b"]},
        "geometry": {"type": kind, "coordinates": coordinates},
    }


RING = [[18.0, 59.0], [18.5, 59.0], [18.5, 59.5], [18.0, 59.0]]
FEATURES = [
    feature("a", "Polygon", [RING]),
    feature("b", "MultiPolygon", [[RING], [RING]]),
    feature("c", "Point", [18.1, 59.1]),
]


def check_layer(layer):
    rows = {r.properties["name"]: r for r in layer.withColumn("rings", polygon_rings(F.col("coordinates"))).collect()}
    assert {name: r.geometry_type for name, r in rows.items()} == {"a": "Polygon", "b": "MultiPolygon", "c": "Point"}
    assert rows["a"].rings == [RING] and rows["a"].properties["size"] == "3"
    assert json.loads(rows["b"].coordinates) == FEATURES[1]["geometry"]["coordinates"]
    assert json.loads(rows["a"].properties["tags"]) == ["a", "b"]


def test_pretty_printed_collections(spark, tmp_path):
    for index, part in enumerate((FEATURES[:2], FEATURES[2:])):
        document = {"type": "FeatureCollection", "name": "layer", "features": part}
        (tmp_path / f"{index}.geojson").write_text(json.dumps(document, indent=2))
    check_layer(read_collections(spark, str(tmp_path)))


def test_feature_lines_read_alike(spark, tmp_path):
    (tmp_path / "layer.geojsonl").write_text("\n".join(json.dumps(f) for f in FEATURES))
    check_layer(read_feature_lines(spark, str(tmp_path)))
    assert bag(read_feature_lines(spark, str(tmp_path)).select("type")) == {("Feature",): 3}
