"""Year-over-year, compound, half-span and split-year growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantlens.functions.numbers import compound_growth, growth, round4


def with_previous(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Value of the previous observed year. Input holds one row per (keys, year)."""
    window = Window.partitionBy(*keys).orderBy("year")
    return df.withColumn(name, F.lag(value).over(window))


def endpoints(yearly: DataFrame, keys: Sequence[str], value: str = "patents") -> DataFrame:
    """First and last year, the values there, and the total, in one aggregate."""
    return yearly.groupBy(*keys).agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min_by(value, "year").alias("first_year_patents"),
        F.max_by(value, "year").alias("last_year_patents"),
        F.sum(value).alias("total_patents"),
    )


def compound_growth_table(
    yearly: DataFrame, keys: Sequence[str], min_total: int, min_span: int
) -> DataFrame:
    span = F.col("last_year") - F.col("first_year")
    rate = compound_growth(
        F.col("first_year_patents"), F.col("last_year_patents"), F.col("span_years")
    )
    return (
        endpoints(yearly, keys)
        .withColumn("span_years", span)
        .filter(
            (F.col("total_patents") >= min_total)
            & (F.col("span_years") >= min_span)
            & (F.col("first_year_patents") > 0)
        )
        .withColumn("cagr", round4(rate))
    )


def midpoint(patents: DataFrame) -> Column:
    """Middle of the span of years as a scalar subquery (real division, may end in .5)."""
    bounds = patents.filter(F.col("year").isNotNull()).agg(
        ((F.min("year") + F.max("year")) / F.lit(2)).alias("middle")
    )
    return bounds.scalar()


def two_sided_counts(
    pairs: DataFrame, key: str, early: Column, names: tuple[str, str]
) -> DataFrame:
    """Patents per key on either side of a year condition.

    ``pairs`` holds each (key, patent) once, so both counts are plain ones.
    """
    sided = pairs.withColumn("_early", early)
    return sided.groupBy(key).agg(
        F.count_if(F.col("_early")).alias(names[0]), F.count_if(~F.col("_early")).alias(names[1])
    )


HALVES = ("first_half_patents", "second_half_patents")


def half_growth(counts: DataFrame) -> DataFrame:
    """delta, growth and total next to the two half-span counts."""
    first, second = (F.col(c) for c in HALVES)
    return (
        counts.withColumn("delta", second - first)
        .withColumn("growth_pct", round4(growth(second, first)))
        .withColumn("total_patents", first + second)
    )


def split_year_sums(yearly: DataFrame, key: str, year: int) -> DataFrame:
    """Sums of yearly counts before and from ``year`` on."""
    early = F.col("year") < year
    return yearly.groupBy(key).agg(
        F.sum(F.when(early, F.col("patents")).otherwise(0)).alias("before"),
        F.sum(F.when(early, 0).otherwise(F.col("patents"))).alias("after"),
    )


def trend(yearly: DataFrame) -> DataFrame:
    """Year-over-year change and running total of a (year, patents) table.

    The window has no partition key: its input is one row per calendar year.
    """
    window = Window.orderBy("year")
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return yearly.withColumn(
        "yoy", round4(growth(F.col("patents"), F.lag("patents").over(window)))
    ).withColumn("cumulative", F.sum("patents").over(running))
