"""Headerless scored files: named scans and consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.tables import EMISSION_SQL, FCD_SQL, POSITION_CENTRES, emission_records, fcd_records, nearest_sql
from roadpulse.functions.distance import nearest_centre
from roadpulse.plans.consolidation import consolidate
from roadpulse.schemas import SCORED_EMISSION, SCORED_FCD
from roadpulse.sinks.files import write_table
from roadpulse.sources.delimited import read_delimited, read_named
from roadpulse.workspace import fresh_dir


def scored_positions(records: DataFrame) -> DataFrame:
    cluster = nearest_centre([F.col("vehicle_x"), F.col("vehicle_y")], POSITION_CENTRES)
    return records.select("vehicle_x", "vehicle_y", cluster.alias("congestion_cluster"))


def scored_emissions(records: DataFrame) -> DataFrame:
    """Emission rows with a plain estimate standing in for a trained prediction."""
    return records.select(
        "vehicle_fuel", "vehicle_speed", "vehicle_noise", "vehicle_NOx", (F.col("vehicle_fuel") / 900).alias("prediction")
    )


def position_parts(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "scored-fcd")
    write_table(scored_positions(fcd_records(spark, sf_dir)), path, header=False)
    return path


def emission_parts(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "scored-emission")
    write_table(scored_emissions(emission_records(spark, sf_dir)), path, header=False)
    return path


def named_scan_fcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of headerless parts under given names, as one bag of rows."""
    return read_named(spark, position_parts(spark, sf_dir), SCORED_FCD)


def named_scan_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_named(spark, emission_parts(spark, sf_dir), SCORED_EMISSION)


def consolidate_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of the same parts keep both: append never replaces."""
    source, target = position_parts(spark, sf_dir), fresh_dir(spark, "results-fcd")
    consolidate(spark, source, target, SCORED_FCD)
    consolidate(spark, source, target, SCORED_FCD)
    return read_delimited(spark, target, SCORED_FCD, sep=",")


def consolidate_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overwrites leave one copy; Parquet keeps the types."""
    source, target = emission_parts(spark, sf_dir), fresh_dir(spark, "results-emission")
    for _ in range(2):
        consolidate(spark, source, target, SCORED_EMISSION, mode="overwrite", fmt="parquet")
    return spark.read.parquet(target)


def consolidate_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were scored into Parquet, consolidated to text and read back."""
    source, target = fresh_dir(spark, "scored-emission"), fresh_dir(spark, "results-emission")
    write_table(scored_emissions(emission_records(spark, sf_dir)), source, fmt="parquet")
    consolidate(spark, source, target, SCORED_EMISSION, source_fmt="parquet")
    return read_delimited(spark, target, SCORED_EMISSION, sep=",", mode="FAILFAST")


QUERIES = {
    "named_scan_fcd": named_scan_fcd,
    "named_scan_emission": named_scan_emission,
    "consolidate_append": consolidate_append,
    "consolidate_overwrite": consolidate_overwrite,
    "consolidate_parquet": consolidate_parquet,
}

_POSITIONS = f"""
SELECT vehicle_x, vehicle_y, CAST(cluster AS INTEGER) AS congestion_cluster
FROM ({nearest_sql(FCD_SQL, "vehicle_x", "vehicle_y", "event_id", POSITION_CENTRES)})
"""
_EMISSIONS = f"""
SELECT vehicle_fuel, vehicle_speed, vehicle_noise, "vehicle_NOx", vehicle_fuel / 900 AS prediction
FROM ({EMISSION_SQL})
"""

ORACLES = {
    "named_scan_fcd": _POSITIONS,
    "named_scan_emission": _EMISSIONS,
    "consolidate_append": f"{_POSITIONS} UNION ALL {_POSITIONS}",
    "consolidate_overwrite": _EMISSIONS,
    "consolidate_parquet": _EMISSIONS,
}
