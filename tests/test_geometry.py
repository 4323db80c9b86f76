"""Geometries by type, and large documents read by ranges."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan
from roadpulse.functions.geo import bounds_of, coordinates_of, geometry_wkt, parts_of
from roadpulse.operators.mapping import vertices
from roadpulse.sources import geojson_ranges
from roadpulse.sources.geojson import read_collections, read_feature_lines
from roadpulse.sources.geojson_ranges import read_collection_ranges

RING, HOLE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]]
KINDS = {
    "Point": [1.5, 2.0],
    "MultiPoint": [[1.0, 2.0], [3.0, -4.0]],
    "LineString": [[1.0, 2.0], [3.0, 4.0]],
    "MultiLineString": [[[1.0, 2.0], [3.0, 4.0]], [[5.0, 6.0], [7.0, 8.0]]],
    "Polygon": [RING, HOLE],
    "MultiPolygon": [[RING, HOLE], [RING]],
}


@pytest.fixture(scope="module")
def layer(spark):
    rows = [(k, json.dumps(c)) for k, c in KINDS.items()]
    rows += [("Polygon", "[1, 2]"), ("Point", None), (None, "[1, 2]"), ("Circle", "[1, 2]"), ("MultiPoint", "[]"), ("Point", "{broken")]
    return spark.createDataFrame(rows, "geometry_type STRING, coordinates STRING")


def test_each_kind_is_typed_alone(layer):
    kind, text = F.col("geometry_type"), F.col("coordinates")
    for name, coordinates in KINDS.items():
        found = layer.select("geometry_type", coordinates_of(name, kind, text).alias("c")).collect()
        assert found[list(KINDS).index(name)].c == coordinates
        assert all(r.c is None for r in found if r.geometry_type != name)


def test_one_form_for_all(layer):
    found = [r.p for r in layer.select(parts_of(F.col("geometry_type"), F.col("coordinates")).alias("p")).collect()]
    assert found[:6] == [
        [[[[1.5, 2.0]]]],
        [[[[1.0, 2.0]]], [[[3.0, -4.0]]]],
        [[[[1.0, 2.0], [3.0, 4.0]]]],
        [[[[1.0, 2.0], [3.0, 4.0]]], [[[5.0, 6.0], [7.0, 8.0]]]],
        [[RING, HOLE]],
        [[RING, HOLE], [RING]],
    ]
    assert found[7:10] == [None, None, None] and found[10] == []


def test_vertices(layer):
    rows = vertices(layer.where("coordinates like '[%' and coordinates <> '[1, 2]'"), "geometry_type").collect()
    polygon = [(r.part, r.line, r.place, r.lon, r.lat) for r in rows if r.geometry_type == "Polygon"]
    assert polygon == [(0, n, k, *p) for n, ring in enumerate((RING, HOLE)) for k, p in enumerate(ring)]
    assert sum(r.geometry_type == "MultiPolygon" for r in rows) == 12


def test_bounds_and_text(layer):
    parts = parts_of(F.col("geometry_type"), F.col("coordinates"))
    found = layer.select(bounds_of(parts).alias("b"), geometry_wkt(F.col("geometry_type"), parts).alias("t")).collect()
    assert tuple(found[1].b) == (1.0, -4.0, 3.0, 2.0) and tuple(found[10].b) == (None,) * 4
    assert [r.t for r in found[:6]] == [
        "POINT (1.5 2.0)",
        "MULTIPOINT ((1.0 2.0), (3.0 -4.0))",
        "LINESTRING (1.0 2.0, 3.0 4.0)",
        "MULTILINESTRING ((1.0 2.0, 3.0 4.0), (5.0 6.0, 7.0 8.0))",
        "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))",
        "MULTIPOLYGON (((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0)), "
        "((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0)))",
    ]
    assert found[10].t == "MULTIPOINT EMPTY" and found[8].t is None


TRAPS = ['}]}', '{"type":"Feature"}', 'a"b\\', "\\", '\\"}', "[[{", "], {", "né€\U0001f600}", "\n}\n", ""]


def features(seed, n):
    rng = random.Random(seed)
    made = []
    for k in range(n):
        kind = rng.choice(list(KINDS))
        properties = {"id": k, "text": "".join(rng.choice(TRAPS) for _ in range(rng.randrange(4))), "deep": {"a": [{"b": {}}, []]}}
        feature = {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": KINDS[kind]}}
        made.append(dict(sorted(feature.items(), reverse=rng.random() < 0.5)))
    return made


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[1], "1")
    yield lambda size: spark.conf.set(names[0], str(size))
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [64, 333, 5000, 10**7])
@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_equal_whole_documents_and_lines(spark, tmp_path, small_blocks, size, indent):
    """Whatever the blocks cut through: texts, escapes, nested objects, the middle of a feature."""
    folder = tmp_path / "layer"
    folder.mkdir()
    lines = []
    for k in range(2):
        made = features(k, 60 if size < 100 else 150)
        head = {"crs": {"type": "name", "properties": {"x": "}"}}, "type": "FeatureCollection"}
        document = {**head, "features": made, "note": [1, [2]], "bbox": {"type": "Feature"}}
        (folder / f"{k}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=k == 0) + "\n" * k)
        lines += [json.dumps(f) for f in made]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    small_blocks(size)
    found = read_collection_ranges(spark, str(folder))
    got = shown(found)
    small_blocks(10**8)
    assert got == shown(read_feature_lines(spark, str(tmp_path / "lines.json")))
    assert got == shown(read_collections(spark, str(folder)))


def shown(features):
    """Geometries and properties, apart from how their JSON is spaced."""
    spaced = F.col("properties")["deep"]
    rows = features.select(
        "type", F.col("properties")["id"], F.col("properties")["text"], F.regexp_replace(spaced, r"\s", ""), "geometry_type",
        F.regexp_replace("coordinates", r"\s", ""),
    )
    return bag(rows)


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": features(5, 400)}))
    small_blocks(2000)
    found = read_collection_ranges(spark, str(tmp_path / "one.json"))
    tasks = found.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 8 and "BatchEvalPython" not in plan(found)


def test_empty_odd_and_too_many(spark, tmp_path, small_blocks, monkeypatch):
    texts = ["", "{}", '{"type":"FeatureCollection","features":[]}', '{"type":"FeatureCollection","features":[{}, {"a": 1}, 3]}', "no json }}} {["]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.json").write_text(text)
    assert read_collection_ranges(spark, str(tmp_path)).count() == 0
    small_blocks(8)
    monkeypatch.setattr(geojson_ranges, "MOST_BLOCKS", 2)
    with pytest.raises(ValueError, match="more than 2 blocks"):
        read_collection_ranges(spark, str(tmp_path))


def test_several_documents_in_one_file(spark, tmp_path, small_blocks):
    made = features(9, 40)
    text = "\n".join(json.dumps({"type": "FeatureCollection", "features": made[k : k + 10]}) for k in range(0, 40, 10))
    (tmp_path / "many.json").write_text(text)
    small_blocks(700)
    assert read_collection_ranges(spark, str(tmp_path / "many.json")).count() == 40
