"""Batch replay of a recorded feed."""

from __future__ import annotations

from pyspark.sql import Column, Observation, SparkSession

from roadpulse.config import Feed
from roadpulse.sinks.delivery import counted
from roadpulse.sinks.files import write_table
from roadpulse.sinks.messages import write_kafka, write_lines
from roadpulse.sources.delimited import read_apart, read_cells, rejected_lines, whole_cells
from roadpulse.streaming.replay import ON_RAGGED, feed_messages, line_counts


def replay(
    spark: SparkSession,
    source: str | list[str],
    feed: Feed,
    *,
    lines: str | None = None,
    servers: str | None = None,
    key: Column | None = None,
    on_ragged: str = "fail",
    rejected: str | None = None,
) -> dict[str, int]:
    """Send a whole recording at once; returns how many messages each topic got.

    Lines with another number of cells than the header: see ``start_replay``. With
    ``"quarantine"`` the result counts them under ``rejected`` as well, and the
    recording is read a second time only if there are any.
    """
    if (lines is None) == (servers is None):
        raise ValueError("name one target: lines or servers")
    if on_ragged not in ON_RAGGED or (on_ragged == "quarantine") != (rejected is not None):
        raise ValueError(f"on_ragged must be one of {ON_RAGGED}, with a folder for rejected lines if it is quarantine")
    if on_ragged == "quarantine":
        observation = Observation()
        apart = read_apart(spark, source)
        messages = feed_messages(whole_cells(apart.observe(observation, *line_counts(feed.topic))), feed, key)
    else:
        messages, observation = counted(feed_messages(read_cells(spark, source, on_ragged=on_ragged), feed, key), [feed.topic])
    if lines:
        write_lines(messages, lines)
    else:
        write_kafka(messages, servers)
    counts = dict(observation.get)
    if counts.get("rejected"):
        write_table(rejected_lines(apart), rejected, "json")
    return counts
