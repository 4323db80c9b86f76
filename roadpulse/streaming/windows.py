"""Scored messages summed up by windows of their own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType, TimestampType

from roadpulse.config import Feed
from roadpulse.sinks.files import stream_writer
from roadpulse.streaming.scoring import ScoringJob, scored_messages

DURATION = "1 minute"
LATENESS = "10 minutes"


def grouped_by(feed: Feed) -> list[str]:
    """Clusters are counted one by one; a predicted quantity is averaged with the rest."""
    return [feed.prediction] if isinstance(feed.scored[feed.prediction].dataType, IntegerType) else []


def window_layout(feed: Feed) -> StructType:
    groups = [feed.scored[name] for name in grouped_by(feed)]
    means = [StructField(f"mean_{f.name}", DoubleType()) for f in feed.scored if f not in groups]
    times = [StructField("window_start", TimestampType()), StructField("window_end", TimestampType())]
    return StructType([*times, *groups, StructField("messages", LongType()), *means])


def window_counts(
    scored: DataFrame, groups: Sequence[str], measures: Sequence[str], duration: str = DURATION, lateness: str | None = None
) -> DataFrame:
    """Per window of ``event_time`` and group: the messages and the mean of each measure, for a table or a stream.

    A stream keeps one row of state for each group of each open window. With
    ``lateness`` a window is final, and its state dropped, once a message that much
    younger than its end was seen; messages that come later still are left out and
    counted in the query's progress (``numRowsDroppedByWatermark``). A message
    without a time is in no window.
    """
    if lateness is not None:
        scored = scored.withWatermark("event_time", lateness)
    means = [F.avg(name).alias(f"mean_{name}") for name in measures]
    found = scored.groupBy(F.window("event_time", duration), *groups).agg(F.count(F.lit(1)).alias("messages"), *means)
    names = [column.alias(name) for name, column in (("window_start", F.col("window.start")), ("window_end", F.col("window.end")))]
    return found.select(*names, *groups, "messages", *[f"mean_{name}" for name in measures])


def feed_windows(scored: DataFrame, feed: Feed, duration: str = DURATION, lateness: str | None = None) -> DataFrame:
    """``window_counts`` of a feed's scored rows, in the columns of ``window_layout``."""
    groups = grouped_by(feed)
    return window_counts(scored, groups, [n for n in feed.scored.names if n not in groups], duration, lateness)


def start_windows(
    job: ScoringJob, duration: str = DURATION, lateness: str = LATENESS, trigger: dict | None = None
) -> StreamingQuery:
    """A query that scores the job's messages and appends each window to ``job.output`` once it is final.

    It has a checkpoint of its own, beside that of the query that writes the scored
    rows; partial sums are made before the shuffle, so a frequent cluster is not
    one task's work. The state grows with the groups within ``lateness``: for many
    of them set ``spark.sql.streaming.stateStore.providerClass`` to RocksDB's.
    Malformed messages are left out here; the scoring query keeps them.
    """
    scored = scored_messages(job.envelopes, job.feed, job.model, event_time=True)
    windows = feed_windows(scored, job.feed, duration, lateness)
    return stream_writer(windows, job.output, job.checkpoint, job.query_name, job.fmt, trigger, job.retention).start()
