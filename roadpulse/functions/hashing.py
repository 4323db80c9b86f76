"""A repeatable position in [0, 1) for every row, from its key alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEX_DIGITS = 8


def row_token(keys: list[str], seed: int) -> Column:
    """The leading hex digits of ``md5(seed:key[:key...])``."""
    cells = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *cells)), 1, HEX_DIGITS)


def token_bound(share: float) -> str:
    """Tokens below this text make up ``share`` of all tokens."""
    return format(int(share * 16**HEX_DIGITS), f"0{HEX_DIGITS}x")
