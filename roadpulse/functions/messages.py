"""Records to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from roadpulse.config import DELIVERY_TEXT
from roadpulse.schemas import subset

# Full microseconds for both timestamp types; the defaults cut to milliseconds.
TIMESTAMP_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_message(schema: StructType) -> Column:
    """The schema's columns, in its order, as one JSON object; NULL fields are kept."""
    return F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false", **TIMESTAMP_TEXT})


def from_message(message: Column, schema: StructType, fields=None) -> Column:
    """JSON text to a struct. Naming ``fields`` parses only those.

    Undecodable text gives a struct of NULLs, a field of the wrong type gives
    NULL in that field alone, and empty text gives a NULL struct.
    """
    parsed = subset(schema, fields) if fields else schema
    return F.from_json(message, parsed, dict(TIMESTAMP_TEXT))


def message_key(columns) -> Column:
    """The named columns as one key text."""
    return F.concat_ws(":", *[F.col(name).cast("string") for name in columns])


def has_values(schema: StructType, names) -> Column:
    """True when every named column holds a usable value (not NULL, not NaN)."""
    usable = F.lit(True)
    for name in names:
        usable = usable & F.col(name).isNotNull()
        if isinstance(schema[name].dataType, (DoubleType, FloatType)):
            usable = usable & ~F.isnan(name)
    return usable


def delivery_text(topic: Column, value: Column) -> Column:
    """The line a producer reports for one delivered message."""
    return F.format_string(DELIVERY_TEXT, topic, value.cast("string"))
