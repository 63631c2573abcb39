"""Consecutive numbers within a parent, safe for a parent with very many children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Parents with more children than this are numbered in slices.
HUGE = 1_000_000
SLICES = 256


def _ascending(order: Sequence[str]) -> Column:
    """One value that compares like the columns one after the other, NULL last."""
    return F.struct(*(field for k, c in enumerate(order)
                      for field in (F.col(c).isNull().alias(f"_n{k}"), F.col(c).alias(f"_v{k}"))))


def number_within(
    df: DataFrame, key: str, order: Sequence[str], name: str, huge: int = HUGE, slices: int = SLICES
) -> DataFrame:
    """row_number per key in the given order; nothing runs before the result is asked for.

    The children of a parent with more than ``huge`` of them fall into up to ``slices`` ranges of the order. The
    bounds are the children with the smallest hashes, so they depend on values alone, and a task that runs again
    finds the same ones. Children are numbered inside their range, after the sizes of the ranges before it.
    ``order`` must tell children apart up to full copies.
    """
    columns = [F.asc_nulls_last(c) for c in order]
    large = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > huge).select(F.col(key).alias("_large"))
    drawn = Window.partitionBy("_large").orderBy(F.xxhash64(*order), *columns)
    sample = (
        df.select(key, *(c for c in order if c != key)).join(large, F.col(key).eqNullSafe(F.col("_large")))
        .withColumn("_turn", F.row_number().over(drawn)).filter(F.col("_turn") < slices)
    )
    bounds = sample.groupBy("_large").agg(F.array_sort(F.collect_list(_ascending(order))).alias("_bounds"))

    placed = df.withColumn("_order", _ascending(order)).join(bounds, F.col(key).eqNullSafe(F.col("_large")), "left")
    passed = F.size(F.filter("_bounds", lambda b: b <= F.col("_order")))
    sliced = placed.withColumn("_cut", F.col("_bounds").isNotNull()).withColumn(
        "_slice", F.when(F.col("_cut"), passed).otherwise(0)).drop("_order", "_bounds", "_large")
    before = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # at most ``slices`` rows per large parent
    starts = (
        sliced.filter("_cut").groupBy(F.col(key).alias("_of"), F.col("_slice").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    )
    local = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*columns))
    same = F.col(key).eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_at"))
    return (
        sliced.withColumn("_local", local).join(starts, same, "left")
        .withColumn(name, (F.col("_local") + F.coalesce("_start", F.lit(0))).cast("int"))
        .select(*df.columns, name)
    )
