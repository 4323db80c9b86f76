"""Score both topics of a broker continuously."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.config import EMISSION_FEED, FCD_FEED, TYPED_EMISSION_FEED
from roadpulse.operators.learning import load
from roadpulse.sources.messages import kafka_stream
from roadpulse.streaming.lifecycle import await_all, stop_all
from roadpulse.streaming.scoring import ScoringJob, start_scoring
from roadpulse.streaming.windows import DURATION, LATENESS, start_windows


def score_topics(
    spark: SparkSession,
    servers: str,
    cluster_model: str,
    regression_model: str,
    clustered: str,
    predicted: str,
    checkpoints: str,
    *,
    fmt: str = "csv",
    event_time: bool = True,
    on_malformed: str = "quarantine",
    trigger: dict | None = None,
    wait: bool = True,
    with_type: bool = False,
    windows: str | None = None,
    window: str = DURATION,
    lateness: str = LATENESS,
    **source_settings,
) -> list[StreamingQuery]:
    """Two independent queries, one per feed; a failure of any ends all.

    ``windows`` names a folder for counts and means by windows of time: two more
    queries, which read the topics on their own, with a folder below it for each
    feed. ``with_type`` is for a forest trained with the kind of vehicle.
    """
    emission = TYPED_EMISSION_FEED if with_type else EMISSION_FEED
    targets = ((FCD_FEED, cluster_model, clustered), (emission, regression_model, predicted))
    jobs = [
        ScoringJob(
            feed=feed,
            envelopes=kafka_stream(spark, servers, feed.topic, **source_settings),
            model=load(model),
            output=output,
            checkpoint=f"{checkpoints}/{feed.name}",
            fmt=fmt,
            event_time=event_time,
            on_malformed=on_malformed,
        )
        for feed, model, output in targets
    ]
    queries = start_scoring(jobs, trigger)
    if windows:
        try:
            for job in jobs:
                name, folder = f"windows-{job.feed.name}", f"{windows}/{job.feed.name}"
                apart = replace(job, output=folder, checkpoint=f"{job.checkpoint}-windows", name=name)
                queries.append(start_windows(apart, window, lateness, trigger))
        except BaseException:
            stop_all(queries)
            raise
    if wait:
        await_all(queries)
    return queries
