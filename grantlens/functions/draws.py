"""Repeatable pseudo-random columns that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) fixed by the key and the salt."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pick(u: Column, weighted: Sequence[tuple[object, float]]) -> Column:
    """Inverse of the cumulative weights; the last value takes the remainder."""
    total = 0.0
    choice = F.when(F.lit(False), F.lit(weighted[0][0]))
    for value, weight in weighted[:-1]:
        total = round(total + weight, 10)
        choice = choice.when(u < total, F.lit(value))
    return choice.otherwise(F.lit(weighted[-1][0]))


def below(u: Column, n: int) -> Column:
    """A whole number in [0, n)."""
    return F.floor(u * F.lit(float(n))).cast("int")


def triangular(u: Column, low: float, mode: float, high: float) -> Column:
    """Inverse of the triangular distribution's cumulative function."""
    turn = (mode - low) / (high - low)
    rising = F.lit(low) + F.sqrt(u * F.lit((high - low) * (mode - low)))
    falling = F.lit(high) - F.sqrt((F.lit(1.0) - u) * F.lit((high - low) * (high - mode)))
    return F.when(u < turn, rising).otherwise(falling)
