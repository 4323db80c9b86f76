"""How many messages went to each topic, counted by the job that sends them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

METRICS = "delivered"


def _counters(topics: Iterable[str]):
    return [F.count_if(F.col("topic") == topic).alias(topic) for topic in topics]


def counted(messages: DataFrame, topics: Iterable[str]) -> tuple[DataFrame, Observation]:
    """The batch with counters attached; read them from the observation after the write."""
    observation = Observation()
    return messages.observe(observation, *_counters(topics)), observation


def counted_stream(messages: DataFrame, topics: Iterable[str], name: str = METRICS) -> DataFrame:
    """The stream with counters attached to every batch's progress report."""
    return messages.observe(name, *_counters(topics))


def await_delivery(query: StreamingQuery, name: str = METRICS, poll_seconds: float = 1) -> dict[str, int]:
    """Wait for the query to end; returns what all its batches delivered, by topic.

    A query keeps only its latest progress reports, so they are gathered by batch
    while it runs.
    """
    batches: dict[int, dict[str, int]] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(poll_seconds)
        for progress in query.recentProgress:
            counters = progress.observedMetrics.get(name)
            if counters:
                batches[progress.batchId] = counters.asDict()
    totals: dict[str, int] = {}
    for counters in batches.values():
        for topic, count in counters.items():
            totals[topic] = totals.get(topic, 0) + count
    return totals


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic of a data set already delivered."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("delivered"))
