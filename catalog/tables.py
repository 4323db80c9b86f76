"""The given tables, and vehicle feeds derived from them row by row.

``FCD_SQL`` and ``EMISSION_SQL`` state the same derivations for the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.config import EMISSION_FEED, FCD_FEED, Feed
from roadpulse.operators.partitioning import in_pieces, tasks_for
from roadpulse.operators.records import as_envelopes
from roadpulse.schemas import EMISSION, FCD
from roadpulse.sources.messages import file_stream
from roadpulse.workspace import fresh_dir

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
LINEITEM = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ"
)

# Centres for the checks that need given ones.
POSITION_CENTRES = [(50.0, 60.0), (50.0, 220.0), (50.0, 380.0), (250.0, 120.0), (250.0, 330.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cores(spark: SparkSession) -> int:
    """Tasks for the given tables at least, which are stored as one piece each."""
    return spark.sparkContext.defaultParallelism


def tasks(records: DataFrame) -> int:
    """Tasks to fit on a table: as many as there are cores, more for a larger one."""
    return tasks_for(records, cores(records.sparkSession))


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """The table as a file stream; the glob serves a single file and a directory."""
    return file_stream(spark, f"{sf_dir}/{name}*.parquet", schema)


def prop_k() -> Column:
    return F.from_json("props", "k INT")["k"]


def fcd_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """Every event as one FCD record, followed by the named event columns."""
    k = prop_k().cast("double")
    columns = {
        "timestep_time": F.col("event_id").cast("double") * 0.5,
        "vehicle_angle": k * 3.6,
        "vehicle_id": F.col("user_id").cast("int"),
        "vehicle_lane": F.concat_ws("_", "event_type", F.length("event_type")),
        "vehicle_pos": F.col("value"),
        "vehicle_slope": F.col("value") / 100,
        "vehicle_speed": F.col("value") / 10,
        "vehicle_type": F.col("event_type"),
        "vehicle_x": F.col("value") * 1.5,
        "vehicle_y": k * 4.5,
    }
    return events.select(*[columns[name].alias(name) for name in FCD.names], *extra)


FCD_SQL = """
SELECT
  CAST(event_id AS DOUBLE) * 0.5 AS timestep_time,
  CAST(props->>'k' AS DOUBLE) * 3.6 AS vehicle_angle,
  CAST(user_id AS INTEGER) AS vehicle_id,
  event_type || '_' || CAST(length(event_type) AS VARCHAR) AS vehicle_lane,
  value AS vehicle_pos,
  value / 100 AS vehicle_slope,
  value / 10 AS vehicle_speed,
  event_type AS vehicle_type,
  value * 1.5 AS vehicle_x,
  CAST(props->>'k' AS DOUBLE) * 4.5 AS vehicle_y,
  event_id,
  ts
FROM events
"""


def emission_from_lineitem(lineitem: DataFrame, *extra: str) -> DataFrame:
    """Every line item as one emission record, followed by the named columns."""
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    columns = {
        "timestep_time": F.col("l_orderkey").cast("double"),
        "vehicle_CO": price / 1000,
        "vehicle_CO2": price / 10,
        "vehicle_HC": F.col("l_tax") * 10,
        "vehicle_NOx": price * (1 - F.col("l_discount")) / 25000,
        "vehicle_PMx": F.col("l_discount"),
        "vehicle_angle": F.col("l_linenumber").cast("double") * 45,
        "vehicle_eclass": F.concat(F.lit("class_"), "l_returnflag"),
        "vehicle_electricity": F.col("l_tax"),
        "vehicle_id": F.col("l_suppkey").cast("int"),
        "vehicle_lane": F.concat_ws("_", "l_linestatus", "l_linenumber"),
        "vehicle_fuel": price / 30,
        "vehicle_noise": quantity / 2 + 42,
        "vehicle_pos": quantity,
        "vehicle_route": F.concat(F.lit("route_"), F.col("l_partkey").cast("string")),
        "vehicle_speed": quantity / 3,
        "vehicle_type": F.col("l_linestatus"),
        "vehicle_waiting": F.col("l_discount") * 100,
        "vehicle_x": quantity * 9,
        "vehicle_y": price / 200,
    }
    return lineitem.select(*[columns[name].alias(name) for name in EMISSION.names], *extra)


EMISSION_SQL = """
SELECT
  CAST(l_orderkey AS DOUBLE) AS timestep_time,
  l_extendedprice / 1000 AS "vehicle_CO",
  l_extendedprice / 10 AS "vehicle_CO2",
  l_tax * 10 AS "vehicle_HC",
  l_extendedprice * (1 - l_discount) / 25000 AS "vehicle_NOx",
  l_discount AS "vehicle_PMx",
  CAST(l_linenumber AS DOUBLE) * 45 AS vehicle_angle,
  'class_' || l_returnflag AS vehicle_eclass,
  l_tax AS vehicle_electricity,
  CAST(l_suppkey AS INTEGER) AS vehicle_id,
  l_linestatus || '_' || CAST(l_linenumber AS VARCHAR) AS vehicle_lane,
  l_extendedprice / 30 AS vehicle_fuel,
  l_quantity / 2 + 42 AS vehicle_noise,
  l_quantity AS vehicle_pos,
  'route_' || CAST(l_partkey AS VARCHAR) AS vehicle_route,
  l_quantity / 3 AS vehicle_speed,
  l_linestatus AS vehicle_type,
  l_discount * 100 AS vehicle_waiting,
  l_quantity * 9 AS vehicle_x,
  l_extendedprice / 200 AS vehicle_y,
  l_shipdate
FROM lineitem
"""


def fcd_records(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return fcd_from_events(table(spark, sf_dir, "events"), *extra)


def emission_records(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return emission_from_lineitem(table(spark, sf_dir, "lineitem"), *extra)


def _fcd_envelopes(events: DataFrame) -> DataFrame:
    return as_envelopes(fcd_from_events(events, "ts"), FCD_FEED, F.col("ts"))


def _emission_envelopes(lineitem: DataFrame) -> DataFrame:
    return as_envelopes(emission_from_lineitem(lineitem, "l_shipdate"), EMISSION_FEED, F.col("l_shipdate"))


def envelopes(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    if feed is FCD_FEED:
        return _fcd_envelopes(in_pieces(table(spark, sf_dir, "events"), cores(spark)))
    return _emission_envelopes(in_pieces(table(spark, sf_dir, "lineitem"), cores(spark)))


def stored_envelopes(spark: SparkSession, sf_dir: str, feed: Feed) -> str:
    """The feed's messages as a directory of files, like a topic of several partitions."""
    path = fresh_dir(spark, f"topic-{feed.name}")
    envelopes(spark, sf_dir, feed).write.option("compression", "zstd").parquet(path)
    return path


def stored_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds' messages stored once as files and read back, like a source of several topics."""
    path = fresh_dir(spark, "topics")
    for feed in (FCD_FEED, EMISSION_FEED):
        envelopes(spark, sf_dir, feed).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def envelope_stream(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    if feed is FCD_FEED:
        return _fcd_envelopes(table_stream(spark, sf_dir, "events", EVENTS))
    return _emission_envelopes(table_stream(spark, sf_dir, "lineitem", LINEITEM))


def naive_time(column: str = "event_time") -> Column:
    """The broker's timestamp without a zone, as the tables hold it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows on the left, and how many distinct rows occur a different number of
    times on the two sides; one shuffle, with equal rows added up before it."""
    marked = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    per_row = marked.groupBy(*left.columns).agg(
        F.sum("_side").alias("_surplus"), F.count_if(F.col("_side") == 1).alias("_left")
    )
    return per_row.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("compared"),
        F.count_if(F.col("_surplus") != 0).alias("differences"),
    )


def nearest_sql(rows: str, x: str, y: str, key: str, centres) -> str:
    """SQL twin of the nearest-centre assignment: rank every centre per row."""
    values = ", ".join(f"({i}, CAST({cx} AS DOUBLE), CAST({cy} AS DOUBLE))" for i, (cx, cy) in enumerate(centres))
    return f"""
      SELECT * FROM (
        SELECT r.*, c.id AS cluster,
          row_number() OVER (
            PARTITION BY r.{key}
            ORDER BY (r.{x} - c.cx) * (r.{x} - c.cx) + (r.{y} - c.cy) * (r.{y} - c.cy), c.id
          ) AS closeness
        FROM ({rows}) AS r CROSS JOIN (VALUES {values}) AS c(id, cx, cy)
      ) WHERE closeness = 1
    """
