"""Text cells to typed values, independent of the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

MISSING = ("zero", "null")
ON_BAD = ("fail", "null")


def is_empty(cell: Column) -> Column:
    """True for a NULL or zero-length cell (the CSV reader turns one into the other)."""
    return F.coalesce(cell, F.lit("")) == ""


def number(name: str, dtype: DataType, *, mandatory: bool = False, missing: str = "zero", on_bad: str = "fail") -> Column:
    """A numeric cell: empty becomes zero (or NULL), unreadable text fails (or is NULL).

    The cell is parsed first and looked at again only when that gives nothing,
    which keeps the generated code of a wide record small enough to compile.
    """
    if missing not in MISSING or on_bad not in ON_BAD:
        raise ValueError(f"missing must be one of {MISSING}, on_bad one of {ON_BAD}")
    cell = F.col(name)
    parsed = cell.try_cast(dtype)
    shown = F.coalesce(cell, F.lit("")) if mandatory else cell
    refused = F.raise_error(F.concat(F.lit(f"{name}: not a {dtype.simpleString()}: "), shown)).cast(dtype)
    unreadable = refused if on_bad == "fail" else F.lit(None).cast(dtype)
    if mandatory:
        return F.coalesce(parsed, unreadable).alias(name)
    blank = F.lit(0 if missing == "zero" else None).cast(dtype)
    return F.coalesce(parsed, F.when((cell == "") | cell.isNull(), blank).otherwise(unreadable)).alias(name)


def text(name: str) -> Column:
    """A text cell; an empty one stays the empty string."""
    return F.coalesce(F.col(name), F.lit("")).alias(name)
