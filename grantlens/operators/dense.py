"""Gap-free numbers for ids, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from grantlens.operators.broadcasting import broadcast_if_bounded

SLICE_ROWS = 1_000_000


def dense_numbers(ids: DataFrame, key: str, by: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``number``: 0, 1, 2, ... over the ids (different ones), anew in each group of ``by``.

    Ids fall into slices by their hash. The slices' sizes add up to where each one starts, and ids are numbered inside
    their slice: a task holds about ``slice_rows`` rows, and a task that runs again gives the same numbers.
    """
    groups = [by] if by else []
    largest = ids.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    slices = -(-largest // slice_rows) or 1
    placed = ids.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(slices)))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*groups, "_slice").count().withColumn(
        "_start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy(*groups, "_slice").orderBy(key)
    numbered = placed.withColumn("_place", F.row_number().over(inside) - 1).alias("p")
    same = " AND ".join(f"p.{c} <=> s.{c}" for c in [*groups, "_slice"])
    # a row per slice and group; groups are few (years)
    return numbered.join(broadcast_if_bounded(starts.alias("s"), 100 * slices), F.expr(same)).select(
        *(f"p.{c}" for c in ids.columns), (F.col("_start") + F.col("_place")).alias("number"))
