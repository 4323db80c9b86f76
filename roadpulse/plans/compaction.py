"""Many small batches of a streaming job to one with few files."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from roadpulse.sinks.files import write_table
from roadpulse.sinks.manifest import Entry, Manifest
from roadpulse.sources.committed import read_folders


def compact(
    spark: SparkSession,
    output: str,
    layouts: Mapping[str, tuple[StructType, str]],
    *,
    files: int | None = None,
    least: int = 2,
    keep_seconds: float = 3600,
    retention_seconds: float | None = None,
) -> int:
    """Rewrites all single batches of a job as one, in fewer files; returns how many there were.

    ``layouts`` gives each output's columns and format. Batches compacted before stay as they are, so a row is
    rewritten once; those that ended more than ``retention_seconds`` ago are dropped from the manifest. With fewer than
    ``least`` single batches and nothing to drop, nothing is done.
    """
    manifest, now = Manifest(spark, output), time.time()
    entries = manifest.entries()
    alive = [e for e in entries if retention_seconds is None or e.at > now - retention_seconds]
    single = [e for e in alive if e.first == e.last]
    if len(single) < least and len(alive) == len(entries):
        return 0
    kept = [e for e in alive if e.first < e.last] if len(single) >= least else alive
    if len(single) >= least:
        first, last, folders = single[0].first, single[-1].last, {}
        for name, (schema, fmt) in layouts.items():
            rows = read_folders(spark, [e.folders[name] for e in single], schema, fmt)
            root = single[0].folders[name].rsplit("/", 1)[0]
            folders[name] = f"{root}/merged-{first:09d}-{last:09d}"
            write_table(rows.coalesce(files) if files else rows, folders[name], fmt, "overwrite", header=False)
        kept = [*kept, Entry(first, last, folders, single[-1].at)]
    manifest.replace(entries, kept, keep_seconds)
    return len(single) if len(single) >= least else 0
