"""Searching sorted arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_or_below(points: Column, value: Column, longest: int) -> Column:
    """How many elements of a sorted array are at or below a value, by binary search.

    ``longest`` bounds the length of the array.  A NULL value gives 0.
    """
    steps = [1 << p for p in reversed(range(max(1, longest.bit_length())))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(F.get(points, low + step - 1) <= value, low + step).otherwise(low),
    )
