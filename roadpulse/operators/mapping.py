"""Scored rows to rows a map can draw."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from roadpulse import config
from roadpulse.config import CONTROL_POINTS, ControlPoint
from roadpulse.functions.geo import latitude, longitude, parts_of, point_wkt
from roadpulse.functions.lookup import colour_of


def with_lat_lon(
    df: DataFrame,
    x: str = "vehicle_x",
    y: str = "vehicle_y",
    points: tuple[ControlPoint, ControlPoint] = CONTROL_POINTS,
) -> DataFrame:
    """Adds ``lat`` and ``lon``."""
    return df.withColumns({"lat": latitude(F.col(y), points), "lon": longitude(F.col(x), points)})


def with_point(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds ``geometry``, the position as WKT text."""
    return df.withColumn("geometry", point_wkt(F.col(lat), F.col(lon)))


def map_layer(
    scored: DataFrame,
    cluster: str = "congestion_cluster",
    colours: Mapping[int, str] = config.COLOURS,
    points: tuple[ControlPoint, ControlPoint] = CONTROL_POINTS,
) -> DataFrame:
    """One marker per scored row: position, popup text and colour."""
    return with_lat_lon(scored, points=points).select(
        "lat",
        "lon",
        F.lit(config.MARKER_TEXT).alias("popup"),
        colour_of(F.col(cluster), colours).alias("colour"),
    )


def vertices(features: DataFrame, *carried: str) -> DataFrame:
    """A row for each position of each feature (geometry_type, coordinates), of whatever kind: the ``carried`` columns,
    part, line and place (all from 0), lon, lat. A feature without positions has no row."""
    parts = features.select(*carried, F.posexplode(parts_of(F.col("geometry_type"), F.col("coordinates"))).alias("part", "_lines"))
    lines = parts.select(*carried, "part", F.posexplode("_lines").alias("line", "_positions"))
    positions = lines.select(*carried, "part", "line", F.posexplode("_positions").alias("place", "_position"))
    lon, lat = F.get("_position", F.lit(0)).alias("lon"), F.get("_position", F.lit(1)).alias("lat")
    return positions.select(*carried, "part", "line", "place", lon, lat)
