"""Records to messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.tables import (
    EMISSION_SQL,
    FCD_SQL,
    POSITION_CENTRES,
    emission_records,
    envelopes,
    fcd_records,
    naive_time,
    nearest_sql,
    prop_k,
    stored_topics,
    table,
)
from roadpulse import config
from roadpulse.config import EMISSION_FEED, FCD_FEED
from roadpulse.functions.distance import nearest_centre
from roadpulse.functions.messages import delivery_text
from roadpulse.operators.mapping import with_lat_lon
from roadpulse.functions.lookup import colour_of
from roadpulse.operators.records import decode, decode_or_quarantine, encode, merge_feeds, on_topic
from roadpulse.schemas import EMISSION, FCD


def congestion_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to coloured map positions: decode, assign, project, colour."""
    records = decode(
        envelopes(spark, sf_dir, FCD_FEED),
        FCD,
        fields=FCD_FEED.features,
        required=FCD_FEED.features,
        on_malformed="skip",
    )
    cluster = nearest_centre([F.col(name) for name in FCD_FEED.features], POSITION_CENTRES)
    placed = with_lat_lon(records.withColumn("congestion_cluster", cluster))
    return placed.select(
        naive_time(),
        "vehicle_x",
        "vehicle_y",
        "congestion_cluster",
        F.round("lat", 9).alias("lat"),
        F.round("lon", 9).alias("lon"),
        F.lit(config.MARKER_TEXT).alias("popup"),
        colour_of(F.col("congestion_cluster")).alias("colour"),
    )


LAT_SQL = "59.321926::DOUBLE + ({y} - 14.01) * ((59.322828::DOUBLE - 59.321926::DOUBLE) / (109.42::DOUBLE - 14.01::DOUBLE))"
LON_SQL = "18.067417::DOUBLE + ({x} - 0.26) * ((18.069380::DOUBLE - 18.067417::DOUBLE) / (116.30::DOUBLE - 0.26::DOUBLE))"
COLOUR_SQL = "CASE {c} WHEN 1 THEN 'blue' WHEN 2 THEN 'green' WHEN 3 THEN 'red' WHEN 4 THEN 'purple' ELSE 'gray' END"

CONGESTION_MAP_SQL = f"""
SELECT ts AS event_time, vehicle_x, vehicle_y, CAST(cluster AS INTEGER) AS congestion_cluster,
  round({LAT_SQL.format(y="vehicle_y")}, 9) AS lat,
  round({LON_SQL.format(x="vehicle_x")}, 9) AS lon,
  'Cluster' AS popup,
  {COLOUR_SQL.format(c="cluster")} AS colour
FROM ({nearest_sql(FCD_SQL, "vehicle_x", "vehicle_y", "event_id", POSITION_CENTRES)})
"""


def envelope_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broker columns renamed and the payload bytes as text."""
    raw = table(spark, sf_dir, "events").select(
        F.col("props").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )
    projected = raw.selectExpr("timestamp AS event_time", "CAST(value AS STRING) AS value")
    return projected.select(naive_time(), "value")


def fcd_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten FCD fields through JSON and back, with the event time."""
    return decode(envelopes(spark, sf_dir, FCD_FEED), FCD).select(naive_time(), *FCD.names)


def emission_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twenty emission fields through JSON and back, with the event time."""
    return decode(envelopes(spark, sf_dir, EMISSION_FEED), EMISSION).select(naive_time(), *EMISSION.names)


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", prop_k().alias("k"))


def _time_in(value: str):
    return F.get_json_object(value, "$.timestep_time").cast("double")


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages keyed by the vehicle and by the one constant key, with the times that they carry."""
    records = fcd_records(spark, sf_dir)
    by_vehicle = encode(records, FCD_FEED, key=F.col("vehicle_id"))
    by_constant = encode(records, FCD_FEED, key=F.lit(config.CONSTANT_KEY))
    sent = merge_feeds(by_vehicle, by_constant).withColumn("time", _time_in("value"))
    return sent.groupBy("topic", "key").agg(F.count("value").alias("messages"), F.sum("time").alias("times"))


def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds in one message set, each row with its topic, its key and its payload decoded."""
    vehicle = F.col("vehicle_id")
    both = merge_feeds(
        encode(fcd_records(spark, sf_dir), FCD_FEED, vehicle),
        encode(emission_records(spark, sf_dir), EMISSION_FEED, vehicle),
    )
    fields = "timestep_time DOUBLE, vehicle_pos DOUBLE, vehicle_lane STRING, vehicle_route STRING"
    return both.select("topic", "key", F.inline(F.array(F.from_json("value", fields))))


def topic_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic picked out of the stored messages of both, and decoded."""
    chosen = on_topic(stored_topics(spark, sf_dir), EMISSION_FEED.topic)
    return decode(chosen, EMISSION, fields=["timestep_time", "vehicle_id", "vehicle_route"]).select(
        "timestep_time", "vehicle_id", "vehicle_route"
    )


def delivery_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report line of every message."""
    return table(spark, sf_dir, "events").select(
        "event_id", delivery_text(F.lit(FCD_FEED.topic), F.col("props").cast("binary")).alias("line")
    )


def damage(sent: DataFrame) -> DataFrame:
    """The FCD messages of all events; the event type in each decides its damage."""
    text = F.col("value").cast("string")
    kind = F.get_json_object(text, "$.vehicle_type")
    broken = (
        F.when(kind == "error", F.substring(text, F.lit(1), F.length(text) - 2))
        .when(kind == "signup", F.lit("[]"))
        .when(kind == "purchase", F.regexp_replace(text, '"vehicle_x":[^,]*', '"vehicle_x":"far"'))
        .when(kind == "click", F.regexp_replace(text, '"vehicle_angle":[^,]*', '"vehicle_angle":"left"'))
        .otherwise(text)
    )
    return sent.withColumn("value", broken.cast("binary"))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage(envelopes(spark, sf_dir, FCD_FEED))


def malformed_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages decoded as they are: what cannot be read is NULL."""
    return decode(_damaged(spark, sf_dir), FCD).select(
        naive_time(), "timestep_time", "vehicle_angle", "vehicle_id", "vehicle_lane", "vehicle_x", "vehicle_y"
    )


def malformed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged message ends up either decoded or in quarantine."""
    split = decode_or_quarantine(_damaged(spark, sf_dir), FCD, fields=FCD_FEED.features, required=FCD_FEED.features)
    usable = split.records.select(F.lit("decoded").alias("outcome"), naive_time())
    rejected = split.malformed.select(F.lit("quarantined").alias("outcome"), naive_time())
    return usable.unionByName(rejected)


QUERIES = {
    "congestion_map": congestion_map,
    "envelope_projection": envelope_projection,
    "fcd_round_trip": fcd_round_trip,
    "emission_round_trip": emission_round_trip,
    "json_extract": json_extract,
    "message_keys": message_keys,
    "feed_union": feed_union,
    "topic_select": topic_select,
    "delivery_lines": delivery_lines,
    "malformed_kept": malformed_kept,
    "malformed_outcomes": malformed_outcomes,
}

ORACLES = {
    "congestion_map": CONGESTION_MAP_SQL,
    "envelope_projection": "SELECT ts AS event_time, props AS value FROM events",
    "fcd_round_trip": f"SELECT ts AS event_time, * EXCLUDE (ts, event_id) FROM ({FCD_SQL})",
    "emission_round_trip": f"SELECT l_shipdate AS event_time, * EXCLUDE (l_shipdate) FROM ({EMISSION_SQL})",
    "json_extract": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "message_keys": f"""
        SELECT 'stockholm-fcd' AS topic, CAST(vehicle_id AS VARCHAR) AS key, count(*) AS messages,
          sum(timestep_time) AS times
        FROM ({FCD_SQL}) GROUP BY vehicle_id
        UNION ALL
        SELECT 'stockholm-fcd', 'stockholm', count(*), sum(timestep_time) FROM ({FCD_SQL})
    """,
    "feed_union": f"""
        SELECT 'stockholm-fcd' AS topic, CAST(vehicle_id AS VARCHAR) AS key, timestep_time, vehicle_pos, vehicle_lane,
          NULL::VARCHAR AS vehicle_route
        FROM ({FCD_SQL})
        UNION ALL
        SELECT 'stockholm-emission', CAST(vehicle_id AS VARCHAR), timestep_time, vehicle_pos, vehicle_lane, vehicle_route
        FROM ({EMISSION_SQL})
    """,
    "topic_select": f"SELECT timestep_time, vehicle_id, vehicle_route FROM ({EMISSION_SQL})",
    "delivery_lines": """
        SELECT event_id, 'Produces message on topic stockholm-fcd:' || props AS line FROM events
    """,
    "malformed_kept": f"""
        SELECT ts AS event_time,
          CASE WHEN lost THEN NULL ELSE timestep_time END AS timestep_time,
          CASE WHEN lost OR vehicle_type = 'click' THEN NULL ELSE vehicle_angle END AS vehicle_angle,
          CASE WHEN lost THEN NULL ELSE vehicle_id END AS vehicle_id,
          CASE WHEN lost THEN NULL ELSE vehicle_lane END AS vehicle_lane,
          CASE WHEN lost OR vehicle_type = 'purchase' THEN NULL ELSE vehicle_x END AS vehicle_x,
          CASE WHEN lost THEN NULL ELSE vehicle_y END AS vehicle_y
        FROM (SELECT *, vehicle_type IN ('error', 'signup') AS lost FROM ({FCD_SQL}))
    """,
    "malformed_outcomes": """
        SELECT CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'quarantined' ELSE 'decoded' END
            AS outcome, ts AS event_time
        FROM events
    """,
}
