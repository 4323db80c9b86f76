"""Replay in recorded order, in batches of a set size at a set pace."""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadpulse.config import Feed
from roadpulse.functions.messages import message_key
from roadpulse.operators.records import encode, normalise
from roadpulse.operators.slices import placed, starts
from roadpulse.sinks import manifest
from roadpulse.sinks.files import COMPRESSED
from roadpulse.sinks.manifest import Manifest, Output, write_batch
from roadpulse.sinks.messages import MESSAGE_COLUMNS, write_kafka
from roadpulse.sources.delimited import read_cells
from roadpulse.workspace import fresh_dir, get_text, put_text, tidy

TIME = "timestep_time"
#: Slices whose rows share a folder of the landed recording.
SLICES_PER_FOLDER = 100
#: So many slices have a folder each.
FEW = 16
#: The file of a recording that has the number of its last slice; Spark reads no file with such a name.
LAST = "_last"


def land_recording(spark: SparkSession, source: str | list[str], feed: Feed, rows: int, on_ragged: str = "fail") -> str:
    """The feed's records as a Parquet table in the shared folder, cut into slices of ``rows``; its path. The caller
    discards it when the replay is over.

    Few slices have a folder each, which every task writes to, without a shuffle. Of many slices, each is in few files.
    """
    records = normalise(read_cells(spark, source, on_ragged=on_ragged), feed.schema)
    path, begun = fresh_dir(spark, f"recording-{feed.name}"), starts(records, TIME, rows)
    cut = placed(records, TIME, begun).withColumn("folder", F.floor(F.col("slice") / SLICES_PER_FOLDER))
    few = len(begun) <= FEW
    with tidy(spark):
        dealt = cut if few else cut.repartitionByRange("slice", TIME)
        folders = ["folder", "slice"] if few else ["folder"]
        dealt.write.partitionBy(*folders).option("compression", "zstd").parquet(path)
    put_text(spark, f"{path}/{LAST}", str(begun[-1][1] if begun else -1))
    return path


def slice_messages(recording: DataFrame, number: int, feed: Feed, key: Column | None = None) -> DataFrame:
    """One slice as messages: those of a key are in one task, in the order of their time (ties: of all columns)."""
    rows = recording.where((F.col("folder") == number // SLICES_PER_FOLDER) & (F.col("slice") == number))
    chosen = message_key(feed.identity) if key is None else key.cast("string")
    rest = [name for name in feed.schema.names if name != TIME]
    return encode(rows.repartition(chosen).sortWithinPartitions(chosen, TIME, *rest), feed, key)


def replay_in_order(
    spark: SparkSession,
    recording: str,
    feed: Feed,
    progress: str,
    *,
    every: float,
    lines: str | None = None,
    servers: str | None = None,
    key: Column | None = None,
    stop: threading.Event | None = None,
) -> int:
    """Sends the slices of a landed recording one after another, ``every`` seconds from the start of one to that of the
    next or as fast as they can be sent; returns how many were sent now.

    ``<progress>_manifest`` lists what was sent, so that a replay started again goes on behind it. JSON lines have
    each slice once; a broker may get the slice that was being sent when the job was killed a second time. Setting
    ``stop`` ends the replay behind the slice that is being sent.
    """
    if (lines is None) == (servers is None):
        raise ValueError("name one target: lines or servers")
    # The layout is known: nothing is read to find out.
    layout = StructType(list(feed.schema.fields)).add("folder", "long").add("slice", "long")
    table, done, sent = spark.read.schema(layout).parquet(recording), Manifest(spark, progress), 0
    last = int(get_text(spark, f"{recording}/{LAST}"))
    stop, due = stop or threading.Event(), time.monotonic()
    reached = max((entry.last for entry in done.entries()), default=-1)
    for number in range(reached + 1, last + 1):
        if stop.wait(max(0.0, due - time.monotonic())):
            break
        due = max(due, time.monotonic() - every) + every
        messages = slice_messages(table, number, feed, key).select(*MESSAGE_COLUMNS)
        # What the shuffle of a slice wrote is deleted before the next one's.
        with tidy(spark):
            if lines:
                write_batch(done, number, {manifest.MESSAGES: Output(messages, lines, "json", options=COMPRESSED)})
            else:
                write_kafka(messages, servers)
                done.commit(number, {})
        sent += 1
    return sent
