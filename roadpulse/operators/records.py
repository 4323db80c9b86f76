"""Text cells to typed records, and records to messages and back."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StructType

from roadpulse.config import Feed
from roadpulse.functions import coercion
from roadpulse.functions.messages import from_message, has_values, message_key, to_message
from roadpulse.schemas import ENVELOPE, subset

MANDATORY = ("timestep_time",)
MALFORMED_POLICIES = ("keep", "skip", "fail")


def normalise(
    cells: DataFrame,
    schema: StructType,
    *,
    fields=None,
    missing: str = "zero",
    on_bad: str = "fail",
    mandatory=MANDATORY,
) -> DataFrame:
    """Typed records in the schema's column order, found by column name.

    An empty text cell stays ''. An empty numeric cell becomes 0 (``missing="zero"``),
    stays NULL (``"null"``) or removes its row (``"drop"``). A mandatory cell has no
    default. Text that is no number fails the job, or is NULL with ``on_bad="null"``.
    ``fields`` keeps only some columns, so a scan parses no others.
    """
    wanted = subset(schema, fields) if fields else schema
    kept = "null" if missing == "drop" else missing
    if missing == "drop":
        for field in wanted:
            if isinstance(field.dataType, NumericType):
                cells = cells.where(~coercion.is_empty(F.col(field.name)))
    return cells.select(
        *[
            coercion.number(f.name, f.dataType, mandatory=f.name in mandatory, missing=kept, on_bad=on_bad)
            if isinstance(f.dataType, NumericType)
            else coercion.text(f.name)
            for f in wanted
        ]
    )


def encode(records: DataFrame, feed: Feed, key: Column | None = None) -> DataFrame:
    """One keyed JSON message per record, keyed by the feed's identity or as given."""
    chosen = message_key(feed.identity) if key is None else key.cast("string")
    return records.select(
        F.lit(feed.topic).alias("topic"),
        chosen.alias("key"),
        to_message(feed.schema).alias("value"),
    )


def as_envelopes(records: DataFrame, feed: Feed, timestamp: Column) -> DataFrame:
    """The feed's messages with every column a broker delivers, for runs without one."""
    carried = records.withColumn("timestamp", timestamp)
    columns = {
        "key": message_key(feed.identity).cast("binary"),
        "value": to_message(feed.schema).cast("binary"),
        "topic": F.lit(feed.topic),
        "partition": F.lit(0),
        "offset": F.lit(0).cast("bigint"),
        "timestamp": F.col("timestamp").cast("timestamp"),
        "timestampType": F.lit(0),
    }
    return carried.select(*[columns[field.name].alias(field.name) for field in ENVELOPE])


def on_topic(envelopes: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic out of a multi-topic source."""
    return envelopes.where(F.col("topic") == topic)


def merge_feeds(*messages: DataFrame) -> DataFrame:
    """Messages of several feeds as one data set, each row keeping its topic."""
    merged = messages[0]
    for other in messages[1:]:
        merged = merged.unionByName(other)
    return merged


def _parsed(envelopes: DataFrame, schema: StructType, fields, *extra: str) -> DataFrame:
    """``event_time`` and the record's fields, one row per message.

    The record passes through ``inline``: a filter on a parsed field would
    otherwise be pushed below the parsing and parse the JSON a second time.
    """
    payload = envelopes.select(F.col("timestamp").alias("event_time"), F.col("value").cast("string").alias("value"))
    return payload.select("event_time", *extra, F.inline(F.array(from_message(F.col("value"), schema, fields))))


def decode(
    envelopes: DataFrame,
    schema: StructType,
    *,
    fields=None,
    required=(),
    on_malformed: str = "keep",
) -> DataFrame:
    """Typed records plus the broker's timestamp as ``event_time``.

    A message is malformed when a ``required`` field has no usable value. Such
    rows are kept with NULLs, skipped, or made to fail the job. Only ``fields``
    are parsed out of the JSON when given.
    """
    if on_malformed not in MALFORMED_POLICIES:
        raise ValueError(f"on_malformed must be one of {MALFORMED_POLICIES}")
    usable = has_values(schema, required)
    if on_malformed == "keep":
        return _parsed(envelopes, schema, fields)
    if on_malformed == "skip":
        return _parsed(envelopes, schema, fields).where(usable)
    refusal = F.raise_error(F.concat(F.lit("undecodable message: "), F.coalesce("value", F.lit("NULL"))))
    checked = _parsed(envelopes, schema, fields, "value").where(F.when(usable, F.lit(True)).otherwise(refusal.cast("boolean")))
    return checked.drop("value")


def decode_with_text(envelopes: DataFrame, schema: StructType, fields=None) -> DataFrame:
    """Every message's records as ``decode`` keeps them, with the message itself as ``value``."""
    return _parsed(envelopes, schema, fields, "value")


def malformed(envelopes: DataFrame, schema: StructType, required) -> DataFrame:
    """The messages ``decode(..., on_malformed="skip")`` leaves out, as raw text."""
    parsed = _parsed(envelopes, schema, required, "value")
    return parsed.where(~has_values(schema, required)).select("event_time", "value")


class Decoded(NamedTuple):
    records: DataFrame
    malformed: DataFrame


def decode_or_quarantine(envelopes: DataFrame, schema: StructType, *, fields=None, required=()) -> Decoded:
    """Every message lands in exactly one of the two results."""
    return Decoded(
        decode(envelopes, schema, fields=fields, required=required, on_malformed="skip"),
        malformed(envelopes, schema, required),
    )
