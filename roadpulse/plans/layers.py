"""Scored files to a table of map markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators.mapping import map_layer
from roadpulse.schemas import SCORED_FCD
from roadpulse.sources.committed import read_scored


def layer_from_scored(spark: SparkSession, path: str, schema=SCORED_FCD, fmt: str = "csv") -> DataFrame:
    """Markers for a directory of scored positions, headerless text or Parquet."""
    return map_layer(read_scored(spark, path, schema, fmt))
