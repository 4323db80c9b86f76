"""Delimited text. No reader here infers types, so none scans a file twice."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadpulse.functions.messages import TIMESTAMP_TEXT
from roadpulse.schemas import as_text

FEED_SEPARATOR = ";"
# What becomes of a line with fewer or more cells than the header: the job fails, or it is read as far as it
# fits (missing cells are empty, further ones are lost).
ON_RAGGED = ("fail", "keep")
# The columns that hold a ragged line as it came, and what is told of it.
RAGGED, REJECTED = "_ragged_line", "_rejected"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = FEED_SEPARATOR,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """A headed file with declared types.

    The header must name the schema's columns in order: a differing file is an
    error instead of silently shifted columns.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, sep=sep, mode=mode, enforceSchema=False, **TIMESTAMP_TEXT)
        .csv(path)
    )


def _ragged_options(on_ragged: str) -> dict:
    if on_ragged not in ON_RAGGED:
        raise ValueError(f"on_ragged must be one of {ON_RAGGED}")
    # With pruning the parser looks at the wanted cells only and does not notice how many there are.
    return {"mode": "FAILFAST", "columnPruning": False} if on_ragged == "fail" else {}


def read_cells(spark: SparkSession, path: str | list[str], sep: str = FEED_SEPARATOR, on_ragged: str = "fail") -> DataFrame:
    """Headed files with every cell as text, columns named by their own header.

    The header comes from one file; a file with another header is an error, and so
    is a line with another number of cells unless ``on_ragged`` is ``"keep"``.
    ``read_lines`` sets such lines apart.
    """
    return spark.read.options(header=True, sep=sep, enforceSchema=False, **_ragged_options(on_ragged)).csv(path)


class Lines(NamedTuple):
    """The cells of whole lines, and the ragged lines: file, line, cells, expected, kind (short or long)."""

    cells: DataFrame
    rejected: DataFrame


def _cells_in(line: Column, sep: str) -> Column:
    """How many cells a line has; separators within quotes don't count."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")
    return F.size(F.split(bare, re.escape(sep), -1))


def _apart(reader, path: str | list[str], names: list[str], sep: str) -> DataFrame:
    """Every line's cells, and in the column ``REJECTED`` what is to be known of a ragged line."""
    layout = StructType([StructField(name, StringType()) for name in [*names, RAGGED]])
    options = {"header": True, "sep": sep, "enforceSchema": False, "columnPruning": False}
    lines = reader.schema(layout).options(**options, columnNameOfCorruptRecord=RAGGED).csv(path)
    # Spark refuses a scan of the ragged lines alone, so this names a cell as well; it is always true.
    first = F.col(f"`{names[0]}`")
    ragged = F.col(RAGGED).isNotNull() & (first.isNull() | (F.length(first) >= 0))
    cells, line = _cells_in(F.col(RAGGED), sep), F.col(RAGGED).alias("line")
    kind = F.when(cells < len(names), "short").otherwise("long").alias("kind")
    told = F.struct(F.col("_metadata.file_path").alias("file"), line, cells.alias("cells"), F.lit(len(names)).alias("expected"), kind)
    return lines.select(*[f"`{name}`" for name in names], F.when(ragged, told).alias(REJECTED))


def whole_cells(lines: DataFrame) -> DataFrame:
    """The cells of those of ``read_apart``'s lines that are as long as the header."""
    return lines.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The others: file, line, cells, expected, kind."""
    return lines.where(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*")


def read_apart(spark: SparkSession, path: str | list[str], sep: str = FEED_SEPARATOR) -> DataFrame:
    """Headed files with every cell as text and, in the column ``REJECTED``, the ragged lines whole."""
    names = spark.read.options(header=True, sep=sep).csv(path).columns
    return _apart(spark.read, path, names, sep)


def read_lines(spark: SparkSession, path: str | list[str], sep: str = FEED_SEPARATOR) -> Lines:
    """Like ``read_cells``, with ragged lines set apart instead of failing: every line is in just one of the results.
    Each result is a scan of its own."""
    lines = read_apart(spark, path, sep)
    return Lines(whole_cells(lines), rejected_lines(lines))


def ragged_counts(rejected: DataFrame) -> DataFrame:
    """Rejected lines per file and kind."""
    return rejected.groupBy("file", "kind").agg(F.count(F.lit(1)).alias("lines"))


def read_named(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ",", fmt: str = "csv"
) -> DataFrame:
    """Headerless text, or Parquet, in a directory and those below it, under the given names.

    Text with another number of columns, a header line or a cell of another type
    fails the job, and so does Parquet with other columns: nothing is filled in.
    A directory written by a stream carries a log of its committed files; Spark
    reads exactly those when given the directory rather than a glob of parts.
    """
    layout = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    reader = spark.read.option("recursiveFileLookup", True)
    if fmt == "csv":
        # Without pruning every line is counted out, whichever columns are asked for.
        strict = {"mode": "FAILFAST", "columnPruning": False, "header": False, "sep": sep}
        return reader.schema(layout).options(**strict, **TIMESTAMP_TEXT).csv(path)
    stored = reader.format(fmt).load(path)
    if stored.columns != layout.names or [f.dataType for f in stored.schema] != [f.dataType for f in layout]:
        raise ValueError(f"the files hold {stored.schema.simpleString()}, not {layout.simpleString()}")
    return stored


def stream_cells(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = FEED_SEPARATOR,
    files_per_trigger: int | None = None,
    on_ragged: str = "fail",
) -> DataFrame:
    """Headed files as they arrive in a directory, every cell as text.

    ``on_ragged="apart"`` keeps ragged lines in the column ``REJECTED``, for
    ``whole_cells`` and ``rejected_lines``.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if on_ragged == "apart":
        return _apart(reader, path, schema.names, sep)
    options = {"header": True, "sep": sep, "enforceSchema": False, **_ragged_options(on_ragged)}
    return reader.schema(as_text(schema)).options(**options).csv(path)
