"""A recording cut along its own time into batches of a given size."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from roadpulse.workspace import landed, tidy

#: Stretches of time that are summed up first.
SPANS = 1000


def time_slices(records: DataFrame, time: str, rows: int) -> DataFrame:
    """(``time``, slice) for each moment of ``records``: slices follow each other in time and take ``rows`` records each,
    up to the last moment that begins within them; records of one moment are never apart. A moment with more
    records than that fills a slice and leaves the next numbers out."""
    moments = landed(records.groupBy(time).agg(F.count(F.lit(1)).alias("n")), "moments")
    # Stretches of time of equal width are summed up first, so that no task runs over all moments.
    first = moments.agg(F.min(time)).scalar()
    width = moments.agg((F.max(time) - F.min(time)) / SPANS).scalar()
    span = F.when(width > 0, F.floor((F.col(time) - first) / width)).otherwise(F.lit(0)).cast("long")
    moments = moments.withColumn("span", span)
    sums = moments.groupBy("span").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("span", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("earlier"))  # SPANS + 1 rows
    within = Window.partitionBy("span").orderBy(time).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("earlier") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return moments.join(F.broadcast(sums), "span").select(time, F.floor(before / rows).cast("long").alias("slice"))


def starts(records: DataFrame, time: str, rows: int) -> list[tuple[float, int]]:
    """(first moment, number) of each slice in the order of time: two numbers a slice are all that the driver gets."""
    with tidy(records.sparkSession):
        slices = time_slices(records, time, rows).groupBy("slice").agg(F.min(time).cast("double").alias("start"))
        return [(r.start, r.slice) for r in slices.orderBy("slice").collect()]


def placed(records: DataFrame, time: str, begun: list[tuple[float, int]]) -> DataFrame:
    """``records`` with the column ``slice``, for slices that begin as ``starts`` says. A record's slice follows from its own
    time, so nothing is shuffled. Records without a time are in no slice."""
    name, at = "_place", F.col(time).cast("double")
    later = [start for start, _ in begun[1:]]
    finite = [start for start in later if math.isfinite(start)]
    # Spark takes NaN for the largest number and -0.0 for 0.0, and so do slices.
    known = records.where(F.col(time).isNotNull()).withColumn("_time", F.when(F.isnan(at), float("inf")).otherwise(at + 0.0))
    if finite:
        known = Bucketizer(splits=[-math.inf, *finite, math.inf], inputCol="_time", outputCol=name).transform(known)
    else:
        known = known.withColumn(name, F.lit(0.0))
    place = F.col(name).cast("int")
    for start in later[len(finite) :]:
        place = place + (at >= F.lit(start)).cast("int")
    numbers = records.sparkSession.createDataFrame([(k, number) for k, (_, number) in enumerate(begun)], f"{name} INT, slice BIGINT")
    return known.withColumn(name, place).join(F.broadcast(numbers), name).select(*records.columns, "slice")


def sliced(records: DataFrame, time: str, rows: int) -> DataFrame:
    """``records`` with the column ``slice``."""
    return placed(records, time, starts(records, time, rows))
