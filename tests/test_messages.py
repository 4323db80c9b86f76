from __future__ import annotations

import json
import math
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import bag, plan
from roadpulse import config
from roadpulse.config import EMISSION_FEED, FCD_FEED
from roadpulse.functions.messages import delivery_text, from_message, to_message
from roadpulse.operators.records import as_envelopes, decode, decode_or_quarantine, encode, merge_feeds, on_topic
from roadpulse.schemas import ENVELOPE, FCD
from roadpulse.sinks.delivery import counted, topic_counts
from roadpulse.sinks.messages import write_lines
from roadpulse.sources.messages import kafka_options, kafka_stream

AT = datetime(2024, 1, 2, 3, 4, 5, 678901)
GOOD = '{"vehicle_x":1.5,"vehicle_y":2.5,"vehicle_id":3,"vehicle_lane":7}'
MESSAGES = [
    GOOD,
    '{"vehicle_x":1.5,"vehicle_y":2.5',
    "[]",
    "",
    None,
    '{"vehicle_x":"far","vehicle_y":2.5}',
    '{"vehicle_y":2.5}',
    '{"vehicle_x":"NaN","vehicle_y":2.5}',
    '{"vehicle_x":1.0,"vehicle_y":2.5,"vehicle_id":4.7}',
]
USABLE = {GOOD, MESSAGES[8]}


def sent(spark, messages):
    rows = [(m.encode() if m is not None else None, AT) for m in messages]
    return spark.createDataFrame(rows, "value BINARY, timestamp TIMESTAMP")


def one(spark, text, **how):
    (row,) = decode(sent(spark, [text]), FCD, **how).collect()
    return row


def test_whole_record_and_event_time(spark):
    row = one(spark, GOOD)
    assert (row.vehicle_x, row.vehicle_id, row.vehicle_lane, row.vehicle_slope) == (1.5, 3, "7", None)
    assert row.event_time == AT


@pytest.mark.parametrize("text", ['{"vehicle_x":1.5', "[]", "", None])
def test_undecodable_text_gives_nulls_in_one_row(spark, text):
    row = one(spark, text)
    assert row.event_time == AT and set(row[1:]) == {None}


def test_one_bad_field_is_null_alone(spark):
    row = one(spark, '{"vehicle_x":"far","vehicle_y":2.5,"vehicle_id":4.7}')
    assert (row.vehicle_x, row.vehicle_y, row.vehicle_id) == (None, 2.5, None)
    assert math.isnan(one(spark, '{"vehicle_x":"NaN"}').vehicle_x)


def test_skip_and_quarantine_share_out_every_message(spark):
    messages = sent(spark, MESSAGES)
    parts = decode_or_quarantine(messages, FCD, fields=FCD_FEED.features, required=FCD_FEED.features)
    assert sorted(r.vehicle_x for r in parts.records.collect()) == [1.0, 1.5]
    assert parts.records.columns == ["event_time", "vehicle_x", "vehicle_y"]
    rejected = [r.value for r in parts.malformed.collect()]
    assert sorted(rejected, key=str) == sorted((m for m in MESSAGES if m not in USABLE), key=str)


def test_fail_policy_names_the_message(spark):
    required = FCD_FEED.features
    assert decode(sent(spark, [GOOD]), FCD, required=required, on_malformed="fail").count() == 1
    with pytest.raises(PySparkException, match="undecodable message"):
        decode(sent(spark, MESSAGES), FCD, required=required, on_malformed="fail").collect()
    with pytest.raises(ValueError):
        decode(sent(spark, MESSAGES), FCD, on_malformed="ignore")


def test_a_filtered_decode_parses_each_message_once(spark, sf_dir):
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp")
    )
    text = plan(decode(messages, FCD, fields=FCD_FEED.features, required=FCD_FEED.features, on_malformed="skip"))
    assert sum("from_json" in line for line in text.splitlines()) == 1
    assert "Exchange" not in text and "ReadSchema: struct<ts:timestamp_ntz,props:string>" in text


def test_message_text_keeps_order_nulls_and_microseconds(spark):
    rows = spark.createDataFrame([(1, None, AT)], "a INT, b STRING, t TIMESTAMP")
    (text,) = rows.select(to_message(rows.schema)).first()
    assert list(json.loads(text)) == ["a", "b", "t"] and json.loads(text)["b"] is None
    (back,) = rows.select(from_message(F.lit(text), rows.schema)).first()
    assert tuple(back) == (1, None, AT)


def test_special_numbers_survive_the_round_trip(spark):
    records = spark.createDataFrame([(1.0, math.nan, math.inf, -0.0)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    (row,) = records.select(from_message(to_message(records.schema), records.schema)).first()
    assert row.a == 1.0 and math.isnan(row.b) and row.c == math.inf and math.copysign(1, row.d) == -1


def fcd_rows(spark):
    rows = [(float(i), 1.0, i % 2, "l", 1.0, 0.0, 1.0, "car", float(i), 2.0) for i in range(6)]
    return spark.createDataFrame(rows, FCD)


def test_keys_by_column_constant_or_none(spark):
    records = fcd_rows(spark)
    assert {r.key for r in encode(records, FCD_FEED).limit(2).collect()} == {"0.0:0", "1.0:1"}
    assert {r.key for r in encode(records, FCD_FEED, key=F.col("vehicle_id")).collect()} == {"0", "1"}
    assert {r.key for r in encode(records, FCD_FEED, key=F.lit(config.CONSTANT_KEY)).collect()} == {"stockholm"}
    assert {r.key for r in encode(records, FCD_FEED, key=F.lit(None)).collect()} == {None}


def test_envelope_matches_the_broker_layout(spark):
    envelopes = as_envelopes(fcd_rows(spark), FCD_FEED, F.lit(AT))
    assert [(f.name, f.dataType) for f in envelopes.schema] == [(f.name, f.dataType) for f in ENVELOPE]
    assert bag(decode(envelopes, FCD).drop("event_time")) == bag(fcd_rows(spark))


def test_merged_feeds_come_apart_by_topic(spark):
    records = fcd_rows(spark)
    merged = merge_feeds(encode(records, FCD_FEED), encode(records.limit(2), FCD_FEED).withColumn("topic", F.lit("x")))
    assert on_topic(merged, FCD_FEED.topic).count() == 6
    assert bag(topic_counts(merged)) == {(FCD_FEED.topic, 6): 1, ("x", 2): 1}


def test_delivery_is_counted_by_the_write_itself(spark, tmp_path):
    messages, observation = counted(encode(fcd_rows(spark), FCD_FEED), [FCD_FEED.topic, EMISSION_FEED.topic])
    write_lines(messages, str(tmp_path / "out"))
    assert observation.get == {FCD_FEED.topic: 6, EMISSION_FEED.topic: 0}
    assert set(spark.read.json(str(tmp_path / "out")).columns) == {"topic", "key", "value"}


def test_delivery_line(spark):
    row = spark.range(1).select(delivery_text(F.lit("t"), F.lit(b"v")).alias("line")).first()
    assert row.line == "Produces message on topic t:v"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_stream(spark, "broker:9092", FCD_FEED.topic)


def test_kafka_options_hold_only_what_was_set():
    assert kafka_options("broker:9092", "t") == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "t"}
    chosen = kafka_options("b", "t", starting_offsets="earliest", fail_on_data_loss=False, min_partitions=64)
    assert (chosen["startingOffsets"], chosen["failOnDataLoss"], chosen["minPartitions"]) == ("earliest", "false", "64")
