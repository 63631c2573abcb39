"""Shares of a total and concentration measures over result-sized tables.

The inputs hold one row per country, section or period, already aggregated, so
their totals come from a window without a partition key: a few hundred rows in one
task. The costly aggregate below is then computed once; a scalar subquery would
be planned on its own and run most of it a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from grantlens.functions.numbers import ratio, round4


def everything() -> Window:
    return Window.partitionBy()


def with_share(counts: DataFrame, value: str) -> DataFrame:
    """``share`` of each row in the sum of ``value``."""
    whole = F.sum(value).over(everything())
    return counts.withColumn("share", round4(ratio(F.col(value), whole)))


def with_share_of(counts: DataFrame, value: str, total: DataFrame) -> DataFrame:
    """``share`` of each row in a total taken from elsewhere (one row, one column)."""
    return counts.withColumn("share", round4(ratio(F.col(value), total.scalar())))


def concentration(counts: DataFrame, key: str, value: str, heads: tuple[int, ...]) -> DataFrame:
    """One row: squared-share index (0 to 10000), share of the k largest keys, number of keys."""
    position = F.row_number().over(Window.orderBy(F.desc(value), F.asc_nulls_last(key)))
    whole = F.sum(value).cast("double")
    squares = F.sum(F.pow(F.col(value).cast("double"), F.lit(2.0)))
    head = lambda k: F.sum(F.when(F.col("_position") <= k, F.col(value)))
    return counts.withColumn("_position", position).agg(
        round4(ratio(squares * F.lit(10000.0), whole * whole)).alias("hhi"),
        F.count(F.lit(1)).alias("keys"),
        *[round4(ratio(head(k), whole)).alias(f"top{k}_share") for k in heads],
    )
