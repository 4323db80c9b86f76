"""Shared scratch folders for written intermediates and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local-mode session without a setting gets a folder of this machine;
    on a cluster such a folder would be lost with its host, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="roadpulse-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, so a repeated call never meets old files."""
    return f"{shared_root(spark)}/roadpulse/{label}-{uuid.uuid4().hex}"


def landed(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: later passes read that
    instead of repeating the work, and it outlives any executor."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What the shuffles of queries made in here wrote is deleted as soon as each has its result."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that :func:`fresh_dir` named, wherever the shared folder is."""
    if not path.startswith(f"{shared_root(spark)}/roadpulse/"):
        raise ValueError(f"{path} is not a scratch folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder if it is there."""
    target, files = _located(spark, path)
    files.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    target, files = _located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside and renamed. The caller is its only writer."""
    target, files = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft)
    stream.write(text.encode())
    stream.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"could not write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    target, files = _located(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
