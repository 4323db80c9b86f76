"""Scored rows to map layers, and map layers from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.files import position_parts
from catalog.messages import COLOUR_SQL, LAT_SQL, LON_SQL
from catalog.tables import FCD_SQL, POSITION_CENTRES, emission_records, EMISSION_SQL, fcd_records, nearest_sql, table
from roadpulse.functions.geo import COORDINATES, bounds_of, coordinates_of, parts_of, polygon_rings
from roadpulse.functions.lookup import colour_of
from roadpulse.operators.mapping import vertices, with_lat_lon, with_point
from roadpulse.plans.layers import layer_from_scored
from roadpulse.sources.geojson import read_collections, read_feature_lines
from roadpulse.sources.geojson_ranges import read_collection_ranges
from roadpulse.workspace import fresh_dir, landed

# A document is parsed by one task, so its number of features is bounded.
FEATURES_PER_DOCUMENT = 1000


def local_to_lat_lon(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_lat_lon(emission_records(spark, sf_dir).select("vehicle_x", "vehicle_y"))
    return placed.select("vehicle_x", "vehicle_y", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


def point_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The WKT text, taken apart again: how digits are printed differs by engine."""
    points = with_point(with_lat_lon(fcd_records(spark, sf_dir, "event_id"))).select("event_id", "geometry")
    number = r"(-?[0-9.eE+-]+)"

    def group(index: int):
        return F.round(F.regexp_extract("geometry", rf"^POINT\({number} {number}\)$", index).cast("double"), 9)

    return points.select("event_id", group(1).alias("lon"), group(2).alias("lat"))


def cluster_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", "label", colour_of(F.col("label")).alias("colour"))


def map_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored part files to markers."""
    layer = layer_from_scored(spark, position_parts(spark, sf_dir))
    return layer.select(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "popup", "colour")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square per customer as a GeoJSON feature."""
    x, y = F.col("c_acctbal"), F.col("c_nationkey").cast("double")
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
    ring = F.array(*[F.array(a, b) for a, b in corners])
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")).alias("properties"),
            F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        ).alias("feature"),
    )


def _summary(features: DataFrame) -> DataFrame:
    ring = F.get(polygon_rings(F.col("coordinates")), F.lit(0))
    corner = F.get(ring, F.lit(0))
    return features.select(
        F.col("properties")["id"].cast("bigint").alias("id"),
        F.col("properties")["segment"].alias("segment"),
        "type",
        "geometry_type",
        F.size(ring).alias("vertices"),
        F.get(corner, F.lit(0)).alias("x"),
        F.get(corner, F.lit(1)).alias("y"),
    )


def geojson_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole FeatureCollection documents, one per file."""
    path = fresh_dir(spark, "geojson")
    document = F.floor(F.col("c_custkey") / FEATURES_PER_DOCUMENT).alias("document")
    collections = (
        _features(spark, sf_dir)
        .groupBy(document)
        .agg(F.collect_list("feature").alias("features"))
        .select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))
    )
    collections.write.option("maxRecordsPerFile", 1).text(path)
    return _summary(read_collections(spark, path))


def geojson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per line."""
    path = fresh_dir(spark, "geojson")
    _features(spark, sf_dir).select(F.to_json("feature").alias("value")).write.text(path)
    return _summary(read_feature_lines(spark, path))


#: The document is cut into blocks of so many bytes, as a huge one would be into larger ones.
BLOCK_BYTES = 64 << 10


def geojson_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with all features, read by many tasks; texts in it look like the ends of features."""
    path, trap = fresh_dir(spark, "geojson"), F.lit('}]}, "{" \\ {"type":"Feature"}')
    tricky = F.col("feature").withField("properties.trap", F.concat(trap, F.col("feature.properties.segment")))
    features = _features(spark, sf_dir).select(F.lit(1).alias("part"), F.concat(F.lit(", "), F.to_json(tricky)).alias("value"))
    ends = spark.createDataFrame(
        [(0, '{"type": "FeatureCollection", "crs": {"type": "name"}, "features": [{"type":"Feature","properties":{"id":-1}}'), (2, "]}")],
        "part INT, value STRING",
    )
    features.unionByName(ends).orderBy("part").coalesce(1).select("value").write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(BLOCK_BYTES))
    try:
        found = landed(read_collection_ranges(spark, path), "features")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    trapped = found.where(F.col("properties")["trap"] == F.concat(trap, F.col("properties")["segment"]))
    return _summary(trapped)


def _mixed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geometry per customer, of six kinds, as lines of GeoJSON."""
    x, y = F.col("c_acctbal"), F.col("c_nationkey").cast("double")

    def at(dx: int, dy: int):
        return F.array(x + dx, y + dy)

    def square(dx: int):
        return F.array(at(dx, 0), at(dx + 1, 0), at(dx + 1, 1), at(dx, 0))

    kinds = {
        "Point": at(0, 0),
        "MultiPoint": F.array(at(0, 0), at(1, 0)),
        "LineString": F.array(at(0, 0), at(1, 0), at(1, 1)),
        "MultiLineString": F.array(F.array(at(0, 0), at(1, 0)), F.array(at(0, 0), at(0, 1))),
        "Polygon": F.array(square(0), square(5)),
        "MultiPolygon": F.array(F.array(square(0)), F.array(square(10), square(20))),
    }
    geometry = None
    for k, (kind, coordinates) in enumerate(kinds.items()):
        made = F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))
        geometry = F.when(F.col("c_custkey") % 6 == k, made) if geometry is None else geometry.when(F.col("c_custkey") % 6 == k, made)
    properties = F.to_json(F.struct(F.col("c_custkey").alias("id")))
    line = F.format_string('{"type":"Feature","properties":%s,"geometry":%s}', properties, geometry)
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def _mixed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "geojson")
    _mixed_features(spark, sf_dir).write.text(path)
    return read_feature_lines(spark, path).withColumn("id", F.col("properties")["id"].cast("bigint"))


def geometry_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of a layer of mixed geometries."""
    return vertices(_mixed_layer(spark, sf_dir), "id", "geometry_type")


def geometry_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates typed by kind, and the bounds of every geometry."""
    kind, text = F.col("geometry_type"), F.col("coordinates")
    sizes = {k: F.size(coordinates_of(k, kind, text)) for k in COORDINATES}
    shown = _mixed_layer(spark, sf_dir).withColumn("bounds", bounds_of(parts_of(kind, text)))
    return shown.select("id", *[sizes[k].alias(f"{k.lower()}_size") for k in COORDINATES], "bounds.*")


QUERIES = {
    "local_to_lat_lon": local_to_lat_lon,
    "point_geometry": point_geometry,
    "cluster_colours": cluster_colours,
    "map_markers": map_markers,
    "geojson_collections": geojson_collections,
    "geojson_lines": geojson_lines,
    "geojson_ranges": geojson_ranges,
    "geometry_vertices": geometry_vertices,
    "geometry_kinds": geometry_kinds,
}

_LAT, _LON = LAT_SQL.format(y="vehicle_y"), LON_SQL.format(x="vehicle_x")
_SQUARES = """
SELECT c_custkey AS id, c_mktsegment AS segment, 'Feature' AS type, 'Polygon' AS geometry_type,
  5 AS vertices, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y
FROM customer
"""

# Kind, its number, part, line, place and how far from the customer's position.
_POSITIONS = """
SELECT * FROM (VALUES
  ('Point', 0, 0, 0, 0, 0, 0),
  ('MultiPoint', 1, 0, 0, 0, 0, 0), ('MultiPoint', 1, 1, 0, 0, 1, 0),
  ('LineString', 2, 0, 0, 0, 0, 0), ('LineString', 2, 0, 0, 1, 1, 0), ('LineString', 2, 0, 0, 2, 1, 1),
  ('MultiLineString', 3, 0, 0, 0, 0, 0), ('MultiLineString', 3, 0, 0, 1, 1, 0),
  ('MultiLineString', 3, 1, 0, 0, 0, 0), ('MultiLineString', 3, 1, 0, 1, 0, 1)
) AS open(kind, k, part, line, place, dx, dy)
UNION ALL
SELECT kind, k, part, line, place, start + dx, dy
FROM (VALUES ('Polygon', 4, 0, 0, 0), ('Polygon', 4, 0, 1, 5),
  ('MultiPolygon', 5, 0, 0, 0), ('MultiPolygon', 5, 1, 0, 10), ('MultiPolygon', 5, 1, 1, 20)) AS rings(kind, k, part, line, start)
CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 0)) AS corners(place, dx, dy)
"""

ORACLES = {
    "geojson_ranges": _SQUARES,
    "geometry_vertices": f"""
        SELECT c_custkey AS id, kind AS geometry_type, part, line, place, c_acctbal + dx AS lon, CAST(c_nationkey + dy AS DOUBLE) AS lat
        FROM customer JOIN ({_POSITIONS}) ON k = c_custkey % 6
    """,
    "geometry_kinds": f"""
        SELECT c_custkey AS id, {", ".join(
            f"CASE WHEN c_custkey % 6 = {k} THEN {size} END AS {kind.lower()}_size"
            for k, (kind, size) in enumerate({"Point": 2, "MultiPoint": 2, "LineString": 3, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 2}.items())
        )}, min(c_acctbal + dx) AS west, CAST(min(c_nationkey + dy) AS DOUBLE) AS south, max(c_acctbal + dx) AS east,
          CAST(max(c_nationkey + dy) AS DOUBLE) AS north
        FROM customer JOIN ({_POSITIONS}) ON k = c_custkey % 6 GROUP BY c_custkey
    """,
    "local_to_lat_lon": f"""
        SELECT vehicle_x, vehicle_y, round({_LAT}, 9) AS lat, round({_LON}, 9) AS lon FROM ({EMISSION_SQL})
    """,
    "point_geometry": f"SELECT event_id, round({_LON}, 9) AS lon, round({_LAT}, 9) AS lat FROM ({FCD_SQL})",
    "cluster_colours": f"SELECT vec_id, label, {COLOUR_SQL.format(c='label')} AS colour FROM embeddings",
    "map_markers": f"""
        SELECT round({_LAT}, 9) AS lat, round({_LON}, 9) AS lon, 'Cluster' AS popup,
          {COLOUR_SQL.format(c="cluster")} AS colour
        FROM ({nearest_sql(FCD_SQL, "vehicle_x", "vehicle_y", "event_id", POSITION_CENTRES)})
    """,
    "geojson_collections": _SQUARES,
    "geojson_lines": _SQUARES,
}
