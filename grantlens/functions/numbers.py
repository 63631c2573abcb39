"""Ratios, growth and their display forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round4(x: Column) -> Column:
    """Round half up at four places; the form gives the same digits in other SQL engines."""
    return F.floor(x * F.lit(10000.0) + F.lit(0.5)).cast("double") / F.lit(10000.0)


def ratio(part: Column, whole: Column) -> Column:
    """Double division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def growth(new: Column, old: Column) -> Column:
    """(new - old) / old, NULL when there is no old value to compare with."""
    return ratio(new - old, old)


def compound_growth(first: Column, last: Column, span: Column) -> Column:
    """(last / first) ** (1 / span) - 1, NULL when the span or the first value is zero."""
    exponent = F.try_divide(F.lit(1.0).cast("double"), span.cast("double"))
    return F.pow(ratio(last, first), exponent) - F.lit(1.0)


def percent_text(x: Column, digits: int = 1) -> Column:
    """0.4863 -> '48.6 %'; ties go to the even digit."""
    scale = float(10**digits)
    return F.concat((F.rint(x * F.lit(100.0 * scale)) / F.lit(scale)).cast("string"), F.lit(" %"))


def signed_percent_text(x: Column) -> Column:
    """0.1234 -> '+12.3%'."""
    return F.format_string("%+.1f%%", F.rint(x * F.lit(1000.0)) / F.lit(10.0))


def direction_text(x: Column) -> Column:
    return F.when(x >= 0, F.lit("↑ growth")).otherwise(F.lit("↓ decline"))
