"""Windows of time over scored messages: late rows, restarts, both feeds."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.tables import emission_records, fcd_records
from roadpulse.config import EMISSION_FEED, FCD_FEED
from roadpulse.operators import learning
from roadpulse.operators.records import as_envelopes
from roadpulse.schemas import ENVELOPE
from roadpulse.sources.delimited import read_named
from roadpulse.sources.messages import file_stream
from roadpulse.streaming.scoring import ScoringJob
from roadpulse.streaming.windows import feed_windows, start_windows, window_layout

DRAIN = {"availableNow": True}
NOON = datetime(2024, 5, 1, 12)


@pytest.fixture(scope="module")
def model(spark):
    return learning.fit(learning.cluster_pipeline(k=2), fcd_records(spark, "/root/testdata/sf0.001"), FCD_FEED)


def send(spark, path, *rows):
    """(minutes after noon, x, y) as one file of messages."""
    made = spark.createDataFrame([(NOON + timedelta(minutes=m), float(x), float(y)) for m, x, y in rows], "t TIMESTAMP, vehicle_x DOUBLE, vehicle_y DOUBLE")
    rest = {f.name: F.lit(None).cast(f.dataType) for f in FCD_FEED.schema if f.name not in made.columns}
    as_envelopes(made.withColumns(rest), FCD_FEED, F.col("t")).coalesce(1).write.mode("append").parquet(path)


def drain(spark, tmp_path, model, feed=FCD_FEED, **settings):
    job = ScoringJob(
        feed, file_stream(spark, str(tmp_path / "topic"), ENVELOPE), model, str(tmp_path / "windows"), str(tmp_path / "progress"), fmt="parquet"
    )
    query = start_windows(job, "1 minute", "10 minutes", DRAIN, **settings)
    query.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    rows = read_named(spark, job.output, window_layout(feed), fmt="parquet").collect()
    return {(r.window_start.minute + 60 * (r.window_start.hour - 12)): r.messages for r in rows}, dropped, rows


def test_windows_come_once_they_are_final_and_late_rows_are_counted(spark, tmp_path, model):
    topic = str(tmp_path / "topic")
    send(spark, topic, (0.1, 1, 1), (0.5, 1, 3), (1.2, 1, 1), (5, 1, 1))
    assert drain(spark, tmp_path, model)[:2] == ({}, 0)  # all within the lateness
    send(spark, topic, (0.9, 1, 5), (20, 1, 1))  # ten minutes late, still counted
    found, dropped, rows = drain(spark, tmp_path, model)
    assert found == {0: 3, 1: 1, 5: 1} and dropped == 0
    first = next(r for r in rows if r.window_start == NOON)
    assert (first.mean_vehicle_x, first.mean_vehicle_y) == (1.0, 3.0)
    send(spark, topic, (0.2, 1, 1), (9.5, 1, 1), (12, 1, 1))  # too late twice, then one in time
    found, dropped, _ = drain(spark, tmp_path, model)
    assert found == {0: 3, 1: 1, 5: 1} and dropped == 2
    send(spark, topic, (60, 1, 1))
    assert drain(spark, tmp_path, model)[0] == {0: 3, 1: 1, 5: 1, 12: 1, 20: 1}


def test_a_restart_repeats_no_window(spark, tmp_path, model):
    send(spark, str(tmp_path / "topic"), *[(m, m % 7, m % 5) for m in range(60)])
    first = drain(spark, tmp_path, model)[0]
    assert sorted(first) == list(range(49)) and set(first.values()) == {1}
    again, _, rows = drain(spark, tmp_path, model)
    assert again == first and len(rows) == len({(r.window_start, r.congestion_cluster) for r in rows})


def test_messages_without_a_time_or_a_position_are_in_no_window(spark, tmp_path, model):
    topic = str(tmp_path / "topic")
    send(spark, topic, (0, 1, 1), (30, 1, 1))
    made = spark.read.parquet(topic).limit(1)
    made.withColumn("timestamp", F.lit(None).cast("timestamp")).write.mode("append").parquet(topic)
    made.withColumn("value", F.lit("{broken").cast("binary")).write.mode("append").parquet(topic)
    assert drain(spark, tmp_path, model)[0] == {0: 1}


def test_a_predicted_quantity_is_averaged(spark, sf_dir):
    pipeline = learning.regression_pipeline(depth=2, trees=2)
    records = emission_records(spark, sf_dir)
    scored = learning.score(learning.fit(pipeline, records, EMISSION_FEED), records, EMISSION_FEED.scored.names)
    windows = feed_windows(scored.withColumn("event_time", F.lit(NOON)), EMISSION_FEED, "5 minutes")
    assert [(f.name, f.dataType) for f in windows.schema] == [(f.name, f.dataType) for f in window_layout(EMISSION_FEED)]
    (row,) = windows.collect()
    want = scored.agg(F.avg("prediction").alias("p"), F.count(F.lit(1)).alias("n")).first()
    assert row.messages == want.n and row.mean_prediction == pytest.approx(want.p)
    assert row.window_end - row.window_start == timedelta(minutes=5)
