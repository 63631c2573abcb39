"""Turning a year into a period label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The period sets the reports use.
FIVE_YEAR_PERIODS = [(2010, 2014), (2015, 2019), (2020, 2025)]
DECADE_PERIODS = [(1976, 1989), (1990, 1999), (2000, 2009), (2010, 2019), (2020, 2025)]


def closed_period(year: Column, periods: Sequence[tuple[int, int]]) -> Column:
    """Label of the range that holds the year, ``other`` when none does."""
    label = F.when(F.lit(False), F.lit(""))
    for low, high in periods:
        label = label.when(year.between(low, high), F.lit(f"{low}-{high}"))
    return label.otherwise(F.lit("other"))


def open_period(year: Column, periods: Sequence[tuple[int, int]]) -> Column:
    """Like ``closed_period``, but the first and last ranges reach out without end."""
    label = F.when(F.lit(False), F.lit(""))
    for low, high in periods[:-1]:
        label = label.when(year <= high, F.lit(f"{low}-{high}"))
    low, high = periods[-1]
    return label.when(year.isNotNull(), F.lit(f"{low}-{high}"))


def decade(year: Column) -> Column:
    return (F.floor(year / F.lit(10)) * 10).cast("int")
