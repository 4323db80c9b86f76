"""Local grid coordinates to latitude and longitude; GeoJSON geometries to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadpulse.config import CONTROL_POINTS, ControlPoint


def latitude(y: Column, points: tuple[ControlPoint, ControlPoint] = CONTROL_POINTS) -> Column:
    a, b = points
    return F.lit(a.lat) + (y - a.y) * ((b.lat - a.lat) / (b.y - a.y))


def longitude(x: Column, points: tuple[ControlPoint, ControlPoint] = CONTROL_POINTS) -> Column:
    a, b = points
    return F.lit(a.lon) + (x - a.x) * ((b.lon - a.lon) / (b.x - a.x))


def point_wkt(lat: Column, lon: Column) -> Column:
    """``POINT(lon lat)``, the axis order WKT readers expect, at full precision."""
    return F.format_string("POINT(%s %s)", lon, lat)


def polygon_rings(coordinates: Column) -> Column:
    """The rings of a GeoJSON polygon, each an array of ``[lon, lat]`` pairs."""
    return F.from_json(coordinates, "array<array<array<double>>>")


#: The type that the coordinates of each kind of geometry have.
COORDINATES = {
    "Point": "array<double>",
    "MultiPoint": "array<array<double>>",
    "LineString": "array<array<double>>",
    "MultiLineString": "array<array<array<double>>>",
    "Polygon": "array<array<array<double>>>",
    "MultiPolygon": "array<array<array<array<double>>>>",
}


def coordinates_of(kind: str, geometry_type: Column, coordinates: Column) -> Column:
    """The coordinates of a geometry of that kind, typed; NULL for any other, and for text that doesn't fit the kind."""
    return F.when(geometry_type == kind, F.from_json(coordinates, COORDINATES[kind]))


def parts_of(geometry_type: Column, coordinates: Column) -> Column:
    """Any geometry in one form: its parts, each of lines (rings, if it is an area), each of ``[lon, lat]`` positions.

    A point is a part of one line of one position. NULL for kinds without coordinates
    and for text that doesn't fit the kind.
    """
    typed = {kind: coordinates_of(kind, geometry_type, coordinates) for kind in COORDINATES}
    return F.coalesce(
        typed["MultiPolygon"],
        _one(typed["Polygon"]),
        F.transform(typed["MultiLineString"], lambda line: F.array(line)),
        _one(_one(typed["LineString"])),
        F.transform(typed["MultiPoint"], lambda point: F.array(F.array(point))),
        _one(_one(_one(typed["Point"]))),
    )


def _one(value: Column) -> Column:
    """An array of one element, or NULL instead of an array of NULL."""
    return F.when(value.isNotNull(), F.array(value))


def bounds_of(parts: Column) -> Column:
    """west, south, east and north of ``parts_of`` as a struct; NULLs for a geometry without positions."""
    positions = F.flatten(F.flatten(parts))
    lon, lat = F.transform(positions, lambda p: F.get(p, F.lit(0))), F.transform(positions, lambda p: F.get(p, F.lit(1)))
    edges = {"west": F.array_min(lon), "south": F.array_min(lat), "east": F.array_max(lon), "north": F.array_max(lat)}
    return F.struct(*[edge.alias(name) for name, edge in edges.items()])


def geometry_wkt(geometry_type: Column, parts: Column) -> Column:
    """The geometry as text, at full precision; one without positions is ``EMPTY``."""

    def listed(items: Column, one) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(items, one), ", "), F.lit(")"))

    def position(p: Column) -> Column:
        return F.array_join(F.transform(p, lambda number: number.cast("string")), " ")

    def line(positions: Column) -> Column:
        return listed(positions, position)

    def area(rings: Column) -> Column:
        return listed(rings, line)

    first = F.get(parts, F.lit(0))
    text = {
        "Point": line(F.get(first, F.lit(0))),
        "MultiPoint": listed(parts, lambda part: line(F.get(part, F.lit(0)))),
        "LineString": line(F.get(first, F.lit(0))),
        "MultiLineString": listed(parts, lambda part: line(F.get(part, F.lit(0)))),
        "Polygon": area(first),
        "MultiPolygon": listed(parts, area),
    }
    shown = F.lit(None).cast("string")
    for kind, made in text.items():
        shown = F.when(geometry_type == kind, made).otherwise(shown)
    empty = F.coalesce(F.size(F.flatten(F.flatten(parts))) <= 0, F.lit(False))
    return F.when(parts.isNotNull(), F.concat(F.upper(geometry_type), F.lit(" "), F.when(empty, F.lit("EMPTY")).otherwise(shown)))
