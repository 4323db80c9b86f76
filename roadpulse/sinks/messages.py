"""Keyed messages to a broker, or to JSON lines carrying the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.sinks.files import COMPRESSED

MESSAGE_COLUMNS = ("topic", "key", "value")
#: How lines are written. As one task reads a compressed file, files are many rather than large.
LINES = {**COMPRESSED, "maxRecordsPerFile": 250_000, "ignoreNullFields": False}


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Deliver a batch; needs Spark's Kafka connector on the class path."""
    messages.select(*MESSAGE_COLUMNS).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def kafka_writer(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    return (
        messages.select(*MESSAGE_COLUMNS)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def write_lines(messages: DataFrame, path: str, mode: str = "append") -> None:
    """The same three columns as JSON lines."""
    messages.select(*MESSAGE_COLUMNS).write.mode(mode).options(**LINES).json(path)


def lines_writer(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        messages.select(*MESSAGE_COLUMNS)
        .writeStream.format("json")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**LINES)
    )
