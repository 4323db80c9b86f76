"""Many streamed part files to one result data set."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from roadpulse.sinks.files import write_table
from roadpulse.sources.committed import read_scored


def consolidate(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    *,
    mode: str = "append",
    fmt: str = "csv",
    files: int | None = None,
    source_fmt: str = "csv",
) -> None:
    """Rewrite a directory of headerless text or Parquet parts under named, typed columns.

    Of a job that keeps a manifest these are its complete batches.
    Spark packs small parts into scan tasks of ``spark.sql.files.maxPartitionBytes``
    and each task writes one file, so parts are merged without a shuffle.
    ``files`` lowers the number of files further, and with it the parallelism.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target must differ")
    rows = read_scored(spark, source, schema, source_fmt)
    write_table(rows.coalesce(files) if files else rows, target, fmt=fmt, mode=mode)
