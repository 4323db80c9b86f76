"""Squared Euclidean distances to a handful of known centres."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Squared differences one generated expression may hold.
EXPRESSION_TERMS = 64


def squared_distance(features: Sequence[Column], centre: Sequence[float]) -> Column:
    terms = [(f - float(c)) * (f - float(c)) for f, c in zip(features, centre, strict=True)]
    return reduce(lambda left, right: left + right, terms)


def nearest_centre(features: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """The index of the closest centre, the lowest index on a tie, NULL for NULL input.

    Plain ``least`` and ``CASE`` over the distances: no arrays or structs are
    built per row, and generated code computes each distance once.
    """
    distances = [squared_distance(features, centre) for centre in centres]
    if len(distances) == 1:
        return F.when(distances[0].isNotNull(), F.lit(0))
    closest = F.least(*distances)
    choice = F.when(distances[0] == closest, F.lit(0))
    for index, distance in enumerate(distances[1:], start=1):
        choice = choice.when(distance == closest, F.lit(index))
    return choice
