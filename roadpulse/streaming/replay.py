"""Replay of recorded feeds as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.config import Feed
from roadpulse.operators.records import encode, normalise
from roadpulse.sinks import manifest
from roadpulse.sinks.delivery import METRICS, counted_stream
from roadpulse.sinks.files import COMPRESSED
from roadpulse.sinks.manifest import Manifest, Output, write_batch
from roadpulse.sinks.messages import MESSAGE_COLUMNS, kafka_writer, lines_writer, write_kafka
from roadpulse.sources.delimited import REJECTED, rejected_lines, stream_cells, whole_cells

#: What a replay does with a line that has fewer or more cells than the header.
ON_RAGGED = ("fail", "quarantine", "keep")


def feed_messages(cells: DataFrame, feed: Feed, key: Column | None = None) -> DataFrame:
    """Text cells to messages, for a table or a stream, keyed by the record's identity or by ``key``."""
    return encode(normalise(cells, feed.schema), feed, key)


def line_counts(topic: str) -> list[Column]:
    """Whole lines, under their topic's name, and rejected ones: counters for lines that were read apart."""
    return [
        F.count_if(F.col(REJECTED).isNull()).alias(topic),
        F.count_if(F.col(REJECTED).isNotNull()).alias("rejected"),
    ]


def write_apart(batch: DataFrame, number: int, feed: Feed, key: Column | None, rejected: str, lines: str | None, servers: str | None):
    """One batch of lines: the whole ones as messages, the ragged ones to ``rejected``, each line in just one place."""
    batch = batch.persist()
    try:
        messages = feed_messages(whole_cells(batch), feed, key).select(*MESSAGE_COLUMNS)
        outputs = {manifest.RAGGED: Output(rejected_lines(batch), rejected, "json")}
        if lines:
            outputs = {manifest.MESSAGES: Output(messages, lines, "json", options=COMPRESSED)} | outputs
        else:
            # A broker takes no part in the manifest: a batch that is run again is delivered again.
            write_kafka(messages, servers)
        write_batch(Manifest(batch.sparkSession, rejected), number, outputs)
    finally:
        batch.unpersist()


def start_replay(
    spark: SparkSession,
    source: str,
    feed: Feed,
    checkpoint: str,
    *,
    lines: str | None = None,
    servers: str | None = None,
    files_per_trigger: int | None = None,
    trigger: dict | None = None,
    key: Column | None = None,
    on_ragged: str = "fail",
    rejected: str | None = None,
) -> StreamingQuery:
    """Send a directory of recorded files to a broker or to JSON lines.

    ``files_per_trigger`` with ``trigger={"processingTime": "1 second"}`` sets the
    pace. The checkpoint makes a restart go on where the replay stopped. A line
    with another number of cells than the header fails the query, is read as far as
    it fits (``"keep"``) or goes to ``rejected`` as it came (``"quarantine"``);
    delivered and rejected lines are counted in each batch's progress.
    """
    if (lines is None) == (servers is None):
        raise ValueError("name one target: lines or servers")
    if on_ragged not in ON_RAGGED or (on_ragged == "quarantine") != (rejected is not None):
        raise ValueError(f"on_ragged must be one of {ON_RAGGED}, with a folder for rejected lines if it is quarantine")
    name = f"replay-{feed.name}"
    if on_ragged == "quarantine":
        cells = stream_cells(spark, source, feed.schema, files_per_trigger=files_per_trigger, on_ragged="apart")
        writer = cells.observe(METRICS, *line_counts(feed.topic)).writeStream.option("checkpointLocation", checkpoint)
        writer = writer.foreachBatch(lambda batch, number: write_apart(batch, number, feed, key, rejected, lines, servers))
    else:
        cells = stream_cells(spark, source, feed.schema, files_per_trigger=files_per_trigger, on_ragged=on_ragged)
        messages = counted_stream(feed_messages(cells, feed, key), [feed.topic])
        writer = lines_writer(messages, lines, checkpoint) if lines else kafka_writer(messages, servers, checkpoint)
    writer = writer.queryName(name)
    return (writer.trigger(**trigger) if trigger else writer).start()
