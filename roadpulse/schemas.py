"""Record layouts shared by every batch and stream path.

All measures are DOUBLE on every path, so a model never sees a value at a
different precision from the one it was trained on.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def layout(columns: str) -> StructType:
    """``"a double, b string"`` as a schema; needs no running session."""
    schema = StructType()
    for column in columns.split(", "):
        schema = schema.add(*column.split())
    return schema


# Field names and order of the two feeds and of the scored files.
FCD = layout(
    "timestep_time double, vehicle_angle double, vehicle_id integer, vehicle_lane string, "
    "vehicle_pos double, vehicle_slope double, vehicle_speed double, vehicle_type string, "
    "vehicle_x double, vehicle_y double"
)
EMISSION = layout(
    "timestep_time double, vehicle_CO double, vehicle_CO2 double, vehicle_HC double, "
    "vehicle_NOx double, vehicle_PMx double, vehicle_angle double, vehicle_eclass string, "
    "vehicle_electricity double, vehicle_id integer, vehicle_lane string, vehicle_fuel double, "
    "vehicle_noise double, vehicle_pos double, vehicle_route string, vehicle_speed double, "
    "vehicle_type string, vehicle_waiting double, vehicle_x double, vehicle_y double"
)
SCORED_FCD = layout("vehicle_x double, vehicle_y double, congestion_cluster integer")
SCORED_EMISSION = layout(
    "vehicle_fuel double, vehicle_speed double, vehicle_noise double, "
    "vehicle_NOx double, prediction double"
)

# What a Kafka source delivers.
ENVELOPE = layout(
    "key binary, value binary, topic string, partition integer, offset long, "
    "timestamp timestamp, timestampType integer"
)

# A message on its way, and a line of a recording that could not be one.
MESSAGE = layout("topic string, key string, value string")
REJECTED_LINE = layout("file string, line string, cells integer, expected integer, kind string")

# A message that could not be used, as it came.
QUARANTINED = layout("event_time timestamp, value string")

# Coordinates stay JSON text because their nesting depends on the geometry type.
GEOJSON_FEATURE = StructType(
    [
        StructField("type", StringType()),
        StructField("geometry", layout("type string, coordinates string")),
        StructField("properties", MapType(StringType(), StringType())),
    ]
)
GEOJSON = StructType(
    [StructField("type", StringType()), StructField("features", ArrayType(GEOJSON_FEATURE))]
)


def as_text(schema: StructType) -> StructType:
    """The same columns, every one a STRING: the layout of an uncast CSV scan."""
    return StructType([StructField(f.name, StringType()) for f in schema])


def subset(schema: StructType, names) -> StructType:
    """The named fields, in the schema's own order."""
    wanted = set(names)
    unknown = wanted - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    return StructType([f for f in schema if f.name in wanted])


def numeric_names(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, NumericType)]


def with_event_time(schema: StructType) -> StructType:
    """A scored layout followed by the broker's timestamp."""
    return StructType([*schema.fields, StructField("event_time", TimestampType())])
