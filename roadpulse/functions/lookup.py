"""Small fixed lookups."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from roadpulse.config import COLOURS, OTHER_COLOUR


def colour_of(cluster: Column, colours: Mapping[int, str] = COLOURS, other: str = OTHER_COLOUR) -> Column:
    """The colour of a cluster; clusters without one share ``other``."""
    if not colours:
        return F.lit(other)
    table = F.create_map(*[F.lit(part) for part in chain.from_iterable(colours.items())])
    return F.coalesce(F.try_element_at(table, cluster), F.lit(other))
