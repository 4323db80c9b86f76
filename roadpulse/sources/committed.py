"""The rows of a job's complete batches, found by its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from roadpulse.functions.messages import TIMESTAMP_TEXT
from roadpulse.sinks.manifest import SCORED, Manifest, has_manifest
from roadpulse.sources.delimited import read_named


def read_folders(spark: SparkSession, folders: list[str], schema: StructType, fmt: str) -> DataFrame:
    """Headerless text, Parquet or JSON lines of one layout; no folder gives no rows."""
    if not folders:
        return spark.createDataFrame([], schema)
    if fmt == "json":
        return spark.read.schema(schema).options(mode="FAILFAST", **TIMESTAMP_TEXT).json(folders)
    return read_named(spark, folders, schema, fmt=fmt)


def read_committed(spark: SparkSession, output: str, name: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """What the complete batches of the job that writes to ``output`` hold under ``name`` (as ``"scored"``)."""
    folders = [e.folders[name] for e in Manifest(spark, output).entries() if name in e.folders]
    return read_folders(spark, folders, schema, fmt)


def read_scored(spark: SparkSession, output: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """Scored rows of a job: by its manifest if it keeps one, else all that is in the folder or in Spark's log of it."""
    if has_manifest(spark, output):
        return read_committed(spark, output, SCORED, schema, fmt)
    return read_named(spark, output, schema, fmt=fmt)

