"""Tables in as many pieces as the work on them needs, or in pieces that are always the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Equal rows that stay together.
CHUNK = 1000
#: Rows for one task, where a table is dealt anew.
ROWS_PER_TASK = 250_000
_ROWS, _DRAW = "_rows", "_draw"


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """``tasks`` partitions, for one shuffle.

    A file of one row group is one task however many cores wait. Parsing JSON or
    training on such a table repays the shuffle; the caller, who knows how a table
    is stored, says so. Nothing here looks at the table or runs a job.
    """
    return df.repartition(tasks)


def tasks_for(df: DataFrame, least: int) -> int:
    """How many tasks to deal a table to: one for each ``ROWS_PER_TASK`` rows, ``least`` at least, so that a task's share
    stays the same however large the table is. Counts the rows; of Parquet that reads the footers only."""
    return max(least, -(-df.count() // ROWS_PER_TASK))


def in_pieces(df: DataFrame, least: int) -> DataFrame:
    """A table as it is stored if its scan keeps ``least`` tasks about equally busy, else dealt anew by ``spread``.

    Counts the rows of each piece that a scan is cut into; of Parquet that reads the footers only. So a file of one row
    group is dealt out, and a large table isn't shuffled only to be copied.
    """
    pieces = df.groupBy(F.spark_partition_id().alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    even = 0 < largest * least <= 2 * rows
    return df if even else spread(df, max(least, -(-rows // ROWS_PER_TASK)))


def canonical(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """The rows, cut to ``columns``, in ``parts`` partitions that depend on nothing but the rows themselves.

    A row's partition is drawn by its hash and partitions are sorted, so the same
    rows are met in the same order whatever files and partitions they came in.
    Equal rows, of which cells filled with zeros make many, are counted before the
    shuffle and dealt out again behind it, ``CHUNK`` to a draw: they are spread
    over all partitions, and the shuffle has one row for each draw.
    """
    counted = df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias(_ROWS))
    draws = F.sequence(F.lit(0).cast("long"), F.floor((F.col(_ROWS) - 1) / CHUNK))
    drawn = counted.withColumn(_DRAW, F.explode(draws))
    drawn = drawn.withColumn(_ROWS, F.least(F.lit(CHUNK).cast("long"), F.col(_ROWS) - F.col(_DRAW) * CHUNK))
    dealt = drawn.repartition(parts, *columns, _DRAW).sortWithinPartitions(*columns, _DRAW)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(_ROWS)))
    return dealt.select(*columns, again.alias(_DRAW)).drop(_DRAW)
