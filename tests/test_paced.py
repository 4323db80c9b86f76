"""Replay in recorded order at a set rate."""

from __future__ import annotations

import math
import re
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import streams
from catalog.feeds import write_feed
from catalog.tables import emission_records
from roadpulse.config import EMISSION_FEED
from roadpulse.operators.slices import sliced, time_slices
from roadpulse.schemas import EMISSION, MESSAGE
from roadpulse.sources.committed import read_committed
from roadpulse.streaming.paced import FEW, land_recording, replay_in_order, slice_messages
from roadpulse.workspace import fresh_dir, names_in

ROWS = 1000


@pytest.fixture(scope="module")
def recording(spark):
    source = write_feed(spark, emission_records(spark, "/root/testdata/sf0.001").orderBy(F.rand(3)), "shuffled")
    return land_recording(spark, source, EMISSION_FEED, ROWS)


def test_slices_follow_time_and_hold_whole_moments(spark):
    counts = [3, 1, 1, 7, 2, 2, 2, 30, 1, 4]
    rows = spark.createDataFrame([(float(t * t),) for t, n in enumerate(counts) for _ in range(n)], "t DOUBLE")
    found = [r.slice for r in time_slices(rows.repartition(4), "t", 5).orderBy("t").collect()]
    want, before = [], 0
    for n in counts:
        want.append(before // 5)
        before += n
    assert found == want == sorted(want)


def test_slices_of_one_moment_and_of_none(spark):
    one = spark.createDataFrame([(1.0,)] * 9, "t DOUBLE")
    assert [tuple(r) for r in time_slices(one, "t", 2).collect()] == [(1.0, 0)]
    assert time_slices(one.limit(0), "t", 2).count() == 0


def test_messages_of_a_key_are_in_order(spark, recording):
    table = spark.read.parquet(recording)
    for number in (0, 3):
        messages = slice_messages(table, number, EMISSION_FEED, F.col("vehicle_id"))
        for part in messages.rdd.glom().collect():
            seen = {}
            for r in part:
                t = spark_time(r.value)
                assert seen.get(r.key, t) <= t
                seen[r.key] = t
        keys = messages.select("key", F.spark_partition_id().alias("task")).distinct()
        assert keys.count() == messages.select("key").distinct().count()


def spark_time(value):
    import json

    return json.loads(value)["timestep_time"]


def test_batches_have_the_size_and_the_pace_that_were_set(spark, recording, tmp_path):
    target, progress = str(tmp_path / "messages"), str(tmp_path / "progress")
    started = time.monotonic()
    total = emission_records(spark, "/root/testdata/sf0.001").count()
    sent = replay_in_order(spark, recording, EMISSION_FEED, progress, every=1.0, lines=target)
    assert sent == -(-total // ROWS) and time.monotonic() - started >= (sent - 1) * 1.0
    messages = read_committed(spark, progress, "messages", MESSAGE, "json")
    sizes = messages.groupBy(F.input_file_name().substr(-400, 400).alias("f")).count()
    assert messages.count() == total and sizes.count() >= sent
    batch = F.regexp_extract(F.input_file_name(), "batch-([0-9]+)", 1).cast("int").alias("batch")
    opened = messages.select(batch, F.from_json("value", EMISSION)["timestep_time"].alias("t"))
    per_batch = opened.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy("batch").collect()
    assert all(abs(r.n - ROWS) < 20 for r in per_batch[:-1])
    assert all(x.b < y.a for x, y in zip(per_batch, per_batch[1:]))


def test_stopped_and_started_again_it_goes_on(spark, recording, tmp_path):
    where = {"progress": str(tmp_path / "progress"), "lines": str(tmp_path / "messages")}
    stop = threading.Event()
    stop.set()
    assert replay_in_order(spark, recording, EMISSION_FEED, every=0, stop=stop, **where) == 0
    stop = threading.Event()
    threading.Timer(0.2, stop.set).start()
    first = replay_in_order(spark, recording, EMISSION_FEED, every=30, stop=stop, **where)
    assert first == 1
    rest = replay_in_order(spark, recording, EMISSION_FEED, every=0, **where)
    total = emission_records(spark, "/root/testdata/sf0.001").count()
    assert read_committed(spark, where["progress"], "messages", MESSAGE, "json").count() == total
    assert rest == -(-total // ROWS) - 1
    assert replay_in_order(spark, recording, EMISSION_FEED, every=0, **where) == 0
    with pytest.raises(ValueError, match="one target"):
        replay_in_order(spark, recording, EMISSION_FEED, str(tmp_path / "p"), every=0)


def test_a_slice_follows_from_the_time_as_the_join_by_moments_gave_it(spark):
    times = [3.0, -0.0, 0.0, None, math.nan, math.nan, 5.0, 5.0, 5.0, 7.0, 9.0, None, math.inf, -math.inf]
    for kept in (times, [t for t in times if t is None or math.isfinite(t)], [5.0, 5.0], [math.nan, 1.0], [None]):
        rows = spark.createDataFrame([(t, k) for k, t in enumerate(kept)], "t DOUBLE, k INT")
        for size in (1, 2, 3, 100):
            want = rows.join(time_slices(rows, "t", size), "t").select("t", "k", "slice")
            got = sliced(rows, "t", size)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            assert "SortMergeJoin" not in got._jdf.queryExecution().toString()


def test_few_and_many_slices_of_a_recording_hold_the_same_records(spark, recording):
    few = spark.read.parquet(recording)
    source = write_feed(spark, emission_records(spark, "/root/testdata/sf0.001"), "feed")
    many = spark.read.parquet(land_recording(spark, source, EMISSION_FEED, 100))
    assert many.select("slice").distinct().count() > FEW >= few.select("slice").distinct().count()
    assert many.select("folder").distinct().count() == 1
    columns = sorted(EMISSION.names)
    assert few.select(columns).exceptAll(many.select(columns)).isEmpty() and few.count() == many.count()
    # Nothing but a slice's own files is read for it.
    plan = few.where("folder = 0 AND slice = 2")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*slice#\d+ = 2", plan)


def test_a_replay_in_order_leaves_no_recording_and_no_shuffles(spark, tmp_path, monkeypatch):
    names, sf_dir = [], "/root/testdata/sf0.001"
    monkeypatch.setattr(streams, "fresh_dir", lambda spark, label: names.append(fresh_dir(spark, label)) or names[-1])
    monkeypatch.setattr(streams, "land_recording", lambda *a: names.append(land_recording(*a)) or names[-1])
    blocks = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].toString())
    before = {f.name for f in blocks.rglob("shuffle_*.data")}
    rows = streams.replay_in_order(spark, sf_dir)
    assert rows.agg(F.sum("messages")).first()[0] == emission_records(spark, sf_dir).count()
    recordings = [n for n in names if "/recording-" in n]
    assert len(recordings) == 1 and names_in(spark, recordings[0]) == []
    # Those of the feed and of small sums stay until Spark drops them, those of the slices don't.
    left = {f.name.split("_")[1] for f in blocks.rglob("shuffle_*.data") if f.name not in before}
    assert len(left) < streams.SLICES
