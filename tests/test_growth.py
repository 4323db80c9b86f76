"""A task's share and what is written grow no faster than a table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import feeds, models, streams
from catalog.tables import bag_difference, emission_records, fcd_records
from helpers import bag
from roadpulse.config import EMISSION_FEED, FCD_FEED
from roadpulse.operators import learning, partitioning
from roadpulse.operators.partitioning import in_pieces, tasks_for
from roadpulse.sinks.messages import write_lines
from roadpulse.streaming.paced import land_recording, replay_in_order
from roadpulse.workspace import shared_root


@pytest.fixture
def small_shares(monkeypatch):
    monkeypatch.setattr(partitioning, "ROWS_PER_TASK", 100)


@pytest.fixture
def tables(spark, tmp_path):
    """1000 events and as many line items."""
    k = F.col("id")
    value = (k % 97 + 1).cast("double")
    spark.range(0, 1000, 1, 1).select(
        k.alias("event_id"),
        F.timestamp_seconds(k * 60).cast("timestamp_ntz").alias("ts"),
        (k % 50).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ["click", "error", "view"])), (k % 3 + 1).cast("int")).alias("event_type"),
        value.alias("value"),
        F.concat(F.lit('{"k": '), (k % 90).cast("string"), F.lit("}")).alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 1000, 1, 1).select(
        F.floor(k / 4).alias("l_orderkey"),
        (k % 30).alias("l_partkey"),
        (k % 11).alias("l_suppkey"),
        (k % 4 + 1).cast("int").alias("l_linenumber"),
        (k % 50 + 1).cast("double").alias("l_quantity"),
        (value * 1000).alias("l_extendedprice"),
        (k % 10 / 100).cast("double").alias("l_discount"),
        (k % 8 / 100).cast("double").alias("l_tax"),
        F.lit("N").alias("l_returnflag"),
        F.when(k % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_tasks_grow_with_the_rows(spark, small_shares):
    assert [tasks_for(spark.range(n), 8) for n in (0, 1, 800, 801, 5000)] == [8, 8, 8, 9, 50]


def test_a_table_in_even_pieces_is_not_shuffled(spark, tmp_path, small_shares):
    spark.range(0, 1000, 1, 1).write.parquet(f"{tmp_path}/one")
    spark.range(0, 1000, 1, 16).write.parquet(f"{tmp_path}/many")
    one, many = spark.read.parquet(f"{tmp_path}/one"), spark.read.parquet(f"{tmp_path}/many")
    assert in_pieces(many, 2) is many
    assert in_pieces(one, 4).rdd.getNumPartitions() == 10
    assert in_pieces(one.limit(0), 4).count() == 0
    assert sorted(r.id for r in in_pieces(one, 4).collect()) == list(range(1000))


#: The feed of each query's last fit, and the tasks of its fits at least.
FITS = {
    models.kmeans_check: ("fcd", 10),
    models.forest_check: ("emission", 10),
    models.model_round_trip: ("emission", 10),
    models.held_out_parts: ("emission", 10),
    models.training_report: ("emission", 10),
    models.typed_scoring: ("emission", 10),
    models.same_model: ("emission", 12),
}


@pytest.mark.parametrize("query", FITS, ids=lambda q: q.__name__)
def test_fits_deal_larger_tables_to_more_tasks(spark, tables, small_shares, monkeypatch, query):
    class Seen(Exception):
        pass

    (last, least), dealt, fitted = FITS[query], [], learning.fit

    def fit(pipeline, df, feed, tasks=None, parts=None):
        dealt.append(tasks or df.rdd.getNumPartitions())
        if feed.name == last:
            raise Seen
        return fitted(pipeline, df, feed, tasks, parts)

    monkeypatch.setattr(learning, "fit", fit)
    with pytest.raises(Seen):
        query(spark, tables)
    assert min(dealt) >= least


def test_batches_of_a_larger_table_have_several_files(spark, tables, small_shares, monkeypatch):
    seen = []
    stream = streams.file_stream

    def spy(spark, path, *args, files_per_trigger=None, **settings):
        seen.append((files_per_trigger, len([f for f in spark.read.parquet(path).inputFiles()])))
        return stream(spark, path, *args, files_per_trigger=files_per_trigger, **settings)

    monkeypatch.setattr(streams, "file_stream", spy)
    rows = {r.step: (r.scored, r.rejected, r.batches, r.entries) for r in streams.batch_manifest(spark, tables).collect()}
    assert seen == [(3, 12)]
    n = 333
    assert rows == {
        "streamed": (1000 - n, n, 4, 4),
        "killed between outputs": (1000 - n, n, 4, 4),
        "compacted": (1000 - n, n, 4, 1),
        "one more batch": (2 * (1000 - n), 2 * n, 5, 2),
    }


def test_written_feeds_and_messages_are_compressed(spark, tables, tmp_path):
    source = feeds.blanked_emission(spark, tables)
    assert source.startswith(shared_root(spark))
    kept = [f for f in spark.read.text(source).inputFiles()]
    assert kept and all(f.endswith(".csv.gz") for f in kept)
    messages = spark.range(10).select(F.lit("t").alias("topic"), F.lit("k").alias("key"), F.col("id").cast("string").alias("value"))
    write_lines(messages, f"{tmp_path}/lines")
    assert all(f.endswith(".json.gz") for f in spark.read.text(f"{tmp_path}/lines").inputFiles())
    assert spark.read.json(f"{tmp_path}/lines").count() == 10
    recording = land_recording(spark, source, EMISSION_FEED, 300)
    assert replay_in_order(spark, recording, EMISSION_FEED, f"{tmp_path}/progress", every=0, lines=f"{tmp_path}/sent") == 4
    sent = spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/sent")
    assert sent.count() == 1000 and all(f.endswith(".json.gz") for f in sent.inputFiles())


def test_rows_of_a_forest_lie_side_by_side(spark, tables):
    class Kept:
        getStages = staticmethod(learning.regression_pipeline().getStages)
        fit = staticmethod(lambda df: df)

    records = emission_records(spark, tables).orderBy(F.rand(1))
    columns = [*EMISSION_FEED.features, EMISSION_FEED.label]
    dealt = learning.fit(Kept, records, EMISSION_FEED, 3)
    assert dealt.rdd.getNumPartitions() == 3 and bag(dealt) == bag(records.select(*columns))
    # Ranges of the first feature, fuel, follow each other; in no order every other row would cross its middle.
    for part in dealt.rdd.glom().collect():
        high = [r.vehicle_fuel > 1633 for r in part]
        assert sum(a != b for a, b in zip(high, high[1:])) < 20


def test_scores_apart_equals_the_difference_of_the_scored_bags(spark, tables):
    records = fcd_records(spark, tables).select("vehicle_x", "vehicle_y")
    odd = spark.createDataFrame([(0.0, -0.0), (-0.0, 0.0), (0.0, 0.0)], records.schema)
    records = records.unionByName(odd)
    one, two = (learning.fit(learning.cluster_pipeline(k=k), records, FCD_FEED) for k in (3, 5))
    for other, differ in ((one, False), (two, True)):
        got = models.scores_apart(one, other, records, FCD_FEED)
        want = bag_difference(*(learning.score(m, records, FCD_FEED.scored.names) for m in (one, other)))
        assert got.columns == want.columns and bag(got) == bag(want)
        assert (got.first().differences > 0) == differ
    assert models.scores_apart(one, two, records.limit(0), FCD_FEED).first() == (0, 0)
