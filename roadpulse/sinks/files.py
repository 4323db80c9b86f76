"""Batch and streaming file output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.functions.messages import TIMESTAMP_TEXT


#: Options of text that repeats itself, as messages do with the names of their fields: a fifth of the bytes for little time.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_table(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "append", header: bool = True, options: Mapping | None = None
) -> None:
    """A finished table as CSV, with a header or without, as JSON lines or as Parquet."""
    writer = df.write.mode(mode).options(**TIMESTAMP_TEXT)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.options(**(options or {})).format(fmt).save(path)


def stream_writer(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    fmt: str = "csv",
    trigger: dict | None = None,
    retention: str | None = None,
) -> DataStreamWriter:
    """An append-only file sink. Spark logs each committed file next to the data,
    so a restart from the same checkpoint neither repeats nor loses a row.

    ``trigger`` is passed to Spark as is: None runs batches back to back,
    ``{"availableNow": True}`` drains what is there and stops. The log names every
    file for ever unless ``retention`` (``"30 days"``) lets it forget old ones, which
    readers of the directory then no longer see.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**TIMESTAMP_TEXT)
    )
    if fmt == "csv":
        writer = writer.option("header", False)
    if retention:
        writer = writer.option("retention", retention)
    return writer.trigger(**trigger) if trigger else writer
