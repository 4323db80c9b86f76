"""Delimited feeds with empty cells, read back and made into typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.tables import EMISSION_SQL, FCD_SQL, cores, emission_records, fcd_records, table
from roadpulse.config import CONSTANT_KEY, EMISSION_FEED, FCD_FEED
from roadpulse.functions.messages import message_key
from roadpulse.operators.partitioning import ROWS_PER_TASK, in_pieces
from roadpulse.operators.records import normalise
from roadpulse.plans.replaying import replay
from roadpulse.schemas import EMISSION, FCD, MESSAGE, REJECTED_LINE
from roadpulse.sinks.delivery import topic_counts
from roadpulse.sinks.files import COMPRESSED
from roadpulse.sources.delimited import ragged_counts, read_cells, read_delimited, read_lines
from roadpulse.workspace import fresh_dir


def _as_text(records: DataFrame, **options):
    """A writer of headed text. It is compressed, as it repeats itself; as one task reads a compressed file, files are
    many rather than large."""
    return records.write.options(header=True, maxRecordsPerFile=ROWS_PER_TASK, **COMPRESSED, **options)


def write_feed(spark: SparkSession, records: DataFrame, label: str) -> str:
    """A headed, ``;``-separated directory; NULL cells come out empty."""
    path = fresh_dir(spark, label)
    _as_text(in_pieces(records, cores(spark)), sep=";", emptyValue="").csv(path)
    return path


def blank(records: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The records with the named cells emptied wherever their rule holds."""
    return records.withColumns({name: F.when(~F.expr(rule), F.col(name)) for name, rule in rules.items()})


# Which cells are empty, by the values of the row itself.
FCD_BLANKS = {
    "vehicle_angle": "vehicle_pos < 5",
    "vehicle_id": "vehicle_type = 'signup'",
    "vehicle_lane": "vehicle_type = 'error'",
    "vehicle_x": "vehicle_pos > 100",
}
EMISSION_BLANKS = {
    "vehicle_NOx": "vehicle_noise > 60",
    "vehicle_eclass": "vehicle_type = 'O'",
    "vehicle_id": "vehicle_noise < 45",
    "vehicle_route": "vehicle_eclass = 'class_R'",
    "vehicle_fuel": "vehicle_lane = 'F_3'",
}


def blanked_fcd(spark: SparkSession, sf_dir: str) -> str:
    return write_feed(spark, blank(fcd_records(spark, sf_dir), FCD_BLANKS), "fcd")


def blanked_emission(spark: SparkSession, sf_dir: str) -> str:
    return write_feed(spark, blank(emission_records(spark, sf_dir), EMISSION_BLANKS), "emission")


def _blanked_sql(rows: str, schema, rules: dict[str, str], blanks: dict[str, str]) -> str:
    cells = [
        f'CASE WHEN {rules[name]} THEN {blanks.get(name, "0")} ELSE "{name}" END AS "{name}"'
        if name in rules
        else f'"{name}"'
        for name in schema.names
    ]
    return f"SELECT {', '.join(cells)} FROM ({rows})"


FCD_ZERO_SQL = _blanked_sql(FCD_SQL, FCD, FCD_BLANKS, {"vehicle_lane": "''"})
EMISSION_ZERO_SQL = _blanked_sql(
    EMISSION_SQL, EMISSION, EMISSION_BLANKS, {"vehicle_eclass": "''", "vehicle_route": "''"}
)


def coerce_fcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty numeric cells become zero, empty text stays empty."""
    return normalise(read_cells(spark, blanked_fcd(spark, sf_dir)), FCD)


def coerce_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(read_cells(spark, blanked_emission(spark, sf_dir)), EMISSION)


def coerce_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other rule for empty numeric cells: their rows are left out."""
    return normalise(read_cells(spark, blanked_fcd(spark, sf_dir)), FCD, missing="drop")


def coerce_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third rule: empty numeric cells stay NULL."""
    return normalise(read_cells(spark, blanked_fcd(spark, sf_dir)), FCD, missing="null")


# Lines cut short, lines with cells too many, by the kind of event.
SHORT, LONG = "error", "signup"


def ragged_fcd(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text, with the lines of one kind of event cut behind the fifth cell and those of another two cells
    too long."""
    records = fcd_records(spark, sf_dir)
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in FCD.names]
    short, whole = F.concat_ws(";", *cells[:5]), F.concat_ws(";", *cells)
    line = F.when(F.col("vehicle_type") == SHORT, short).when(F.col("vehicle_type") == LONG, F.concat(whole, F.lit(";;more")))
    path = fresh_dir(spark, "ragged")
    # One column whose name is the header: the lines are written as they are.
    lines = in_pieces(records.select(line.otherwise(whole).alias(";".join(FCD.names))), cores(spark))
    _as_text(lines, sep="\u0001", quote="", escapeQuotes=False).csv(path)
    return path


def coerce_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines as typed records, the others set apart with what is wrong with them."""
    lines = read_lines(spark, ragged_fcd(spark, sf_dir))
    whole = normalise(lines.cells, FCD).select(F.lit("whole").alias("kind"), F.lit(10).alias("cells"), *FCD.names)
    first = F.split("line", ";").getItem(0).cast("double").alias("timestep_time")
    rejected = lines.rejected.select("kind", "cells", first)
    return whole.unionByName(rejected, allowMissingColumns=True)


def replay_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recording with ragged lines sent at once: what was delivered and what was rejected, as counted and as stored."""
    target, apart = fresh_dir(spark, "messages"), fresh_dir(spark, "rejected")
    counts = replay(spark, ragged_fcd(spark, sf_dir), FCD_FEED, lines=target, on_ragged="quarantine", rejected=apart)
    stored = topic_counts(spark.read.schema(MESSAGE).json(target)).select(F.col("topic").alias("outcome"), F.col("delivered").alias("stored"))
    kinds = ragged_counts(spark.read.schema(REJECTED_LINE).json(apart)).groupBy("kind").agg(F.sum("lines").alias("stored"))
    found = stored.unionByName(kinds.select(F.col("kind").alias("outcome"), "stored"))
    counted = F.when(F.col("outcome") == FCD_FEED.topic, counts[FCD_FEED.topic]).otherwise(counts["rejected"])
    return found.withColumn("counted", counted.cast("long"))


def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A headed file under declared types."""
    customers = table(spark, sf_dir, "customer")
    path = write_feed(spark, customers, "customer")
    return read_delimited(spark, path, customers.schema)


def cell_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A headed file as text cells, cast afterwards."""
    path = write_feed(spark, table(spark, sf_dir, "customer"), "customer")
    cells = read_cells(spark, path)
    return cells.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """The messages that a replay wrote."""
    return spark.read.schema("topic STRING, key STRING, value STRING").json(path)


def replayed(spark: SparkSession, path: str) -> DataFrame:
    """Delivered messages as records, with the topic and whether the key names the record."""
    messages = delivered(spark, path)
    opened = messages.select("topic", "key", F.inline(F.array(F.from_json("value", FCD))))
    return opened.select("topic", (F.col("key") == message_key(FCD_FEED.identity)).alias("key_fits"), *FCD.names)


def replay_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorded feed to messages and back: the delivered JSON holds every record."""
    target = fresh_dir(spark, "messages")
    replay(spark, blanked_fcd(spark, sf_dir), FCD_FEED, lines=target)
    return replayed(spark, target)


def replay_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same recording sent with a chosen key and with the constant one, read back with what it carries."""
    source, target = blanked_fcd(spark, sf_dir), fresh_dir(spark, "messages")
    for key in (F.col("vehicle_type"), F.lit(CONSTANT_KEY)):
        replay(spark, source, FCD_FEED, lines=target, key=key)
    opened = delivered(spark, target).withColumn("timestep_time", F.get_json_object("value", "$.timestep_time").cast("double"))
    return opened.groupBy("topic", "key").agg(F.count("value").alias("messages"), F.sum("timestep_time").alias("times"))


def delivered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic, counted in what two replays have delivered."""
    target = fresh_dir(spark, "messages")
    replay(spark, blanked_fcd(spark, sf_dir), FCD_FEED, lines=target)
    replay(spark, blanked_emission(spark, sf_dir), EMISSION_FEED, lines=target)
    return topic_counts(delivered(spark, target))


def delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each replay job counted while it delivered, one row per topic."""
    fcd = replay(spark, blanked_fcd(spark, sf_dir), FCD_FEED, lines=fresh_dir(spark, "messages"))
    emission = replay(spark, blanked_emission(spark, sf_dir), EMISSION_FEED, lines=fresh_dir(spark, "messages"))
    return spark.createDataFrame([*fcd.items(), *emission.items()], "topic STRING, delivered BIGINT")


QUERIES = {
    "coerce_fcd": coerce_fcd,
    "coerce_emission": coerce_emission,
    "coerce_drop": coerce_drop,
    "coerce_null": coerce_null,
    "coerce_ragged": coerce_ragged,
    "replay_quarantine": replay_quarantine,
    "typed_scan": typed_scan,
    "cell_scan": cell_scan,
    "replay_batch": replay_batch,
    "replay_keys": replay_keys,
    "delivered_counts": delivered_counts,
    "delivery_report": delivery_report,
}

ORACLES = {
    "coerce_fcd": FCD_ZERO_SQL,
    "coerce_emission": EMISSION_ZERO_SQL,
    "coerce_drop": f"""
        SELECT * FROM ({FCD_ZERO_SQL})
        WHERE NOT (vehicle_pos < 5 OR vehicle_type = 'signup' OR vehicle_pos > 100)
    """,
    "coerce_null": _blanked_sql(
        FCD_SQL,
        FCD,
        FCD_BLANKS,
        {"vehicle_angle": "NULL", "vehicle_id": "NULL", "vehicle_lane": "''", "vehicle_x": "NULL"},
    ),
    "coerce_ragged": f"""
        SELECT CASE vehicle_type WHEN '{SHORT}' THEN 'short' WHEN '{LONG}' THEN 'long' ELSE 'whole' END AS kind,
          CASE vehicle_type WHEN '{SHORT}' THEN 5 WHEN '{LONG}' THEN 12 ELSE 10 END AS cells, timestep_time,
          {", ".join(f"CASE WHEN vehicle_type NOT IN ('{SHORT}', '{LONG}') THEN {n} END AS {n}" for n in FCD.names[1:])}
        FROM ({FCD_SQL})
    """,
    "replay_quarantine": f"""
        SELECT CASE event_type WHEN '{SHORT}' THEN 'short' WHEN '{LONG}' THEN 'long' ELSE 'stockholm-fcd' END AS outcome,
          count(*) AS stored,
          CAST(sum(count(*)) OVER (PARTITION BY outcome IN ('short', 'long')) AS BIGINT) AS counted
        FROM events GROUP BY outcome
    """,
    "typed_scan": "SELECT * FROM customer",
    "cell_scan": "SELECT * FROM customer",
    "replay_batch": f"""
        SELECT 'stockholm-fcd' AS topic, TRUE AS key_fits, * FROM ({FCD_ZERO_SQL})
    """,
    "replay_keys": f"""
        SELECT 'stockholm-fcd' AS topic, key, count(*) AS messages, sum(timestep_time) AS times
        FROM (SELECT vehicle_type AS key, timestep_time FROM ({FCD_SQL})
              UNION ALL SELECT 'stockholm', timestep_time FROM ({FCD_SQL}))
        GROUP BY key
    """,
    "delivered_counts": """
        SELECT 'stockholm-fcd' AS topic, count(*) AS delivered FROM events
        UNION ALL
        SELECT 'stockholm-emission', count(*) FROM lineitem
    """,
    "delivery_report": """
        SELECT 'stockholm-fcd' AS topic, count(*) AS delivered FROM events
        UNION ALL
        SELECT 'stockholm-emission', count(*) FROM lineitem
    """,
}
