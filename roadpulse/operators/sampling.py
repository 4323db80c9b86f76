"""Row caps, previews and train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from roadpulse.config import PREVIEW_ROWS, SPLIT_SEED
from roadpulse.functions.hashing import row_token, token_bound

#: Up to so many rows every task keeps its own first ones and one task merges them; beyond, a cut is looked for first.
HEAP = 1000
#: The sketch of the leading column is right to one part in this many.
ACCURACY = 100_000
_ORDERED = (NumericType, DateType, TimestampType, TimestampNTZType)


def take(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order`` (all rows for None), NULLs first.

    Ties are broken by all other columns, so the rows are the same on any
    partitioning. The table is neither sorted nor shuffled: a task keeps the first
    n rows it meets, and those of all tasks are merged. If ``n`` is large, a sketch
    of the leading column first gives a value that at least n rows don't exceed,
    and the rest is left out before it gets that far.
    """
    if n is None:
        return df
    sortable = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    total = [*order, *(name for name in sortable if name not in order)]
    if n > HEAP and isinstance(df.schema[order[0]].dataType, _ORDERED):
        df = _below(df, n, order[0])
    return df.orderBy(*total).limit(n)


def _below(df: DataFrame, n: int, leading: str) -> DataFrame:
    """``df`` without rows that ``n`` others come before by the column ``leading``, as far as a sketch of it tells."""
    column = F.col(leading)
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.count(column).alias("values")).first()
    wanted = n - (found["rows"] - found["values"])
    if wanted <= 0:
        return df.where(column.isNull())
    # The sketch's value may be off by a place in ACCURACY either way.
    share = wanted / max(found["values"], 1) + 2 / ACCURACY
    if share >= 1:
        return df
    cut = df.agg(F.percentile_approx(column, share, ACCURACY)).scalar()
    return df.where(column.isNull() | (column <= cut))


def preview(df: DataFrame, order: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    return take(df, n, order)


def split(df: DataFrame, shares: Sequence[float], keys: list[str], seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Disjoint parts by a hash of the key: the same row lands in the same part on
    every run, cluster and partitioning, and no part needs a sort or a shuffle."""
    total = sum(shares)
    token = row_token(keys, seed)
    parts, lower = [], None
    for index in range(len(shares)):
        last = index == len(shares) - 1
        upper = None if last else token_bound(sum(shares[: index + 1]) / total)
        chosen = F.lit(True) if lower is None else token >= lower
        if upper is not None:
            chosen = chosen & (token < upper)
        parts.append(df.where(chosen))
        lower = upper
    return parts


def random_split(df: DataFrame, shares: Sequence[float], columns: Sequence[str], seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Spark's own split, which depends on the partitioning and sorts each partition
    by every column; name the needed columns so that it sorts no others."""
    return df.select(*columns).randomSplit(list(shares), seed=seed)
