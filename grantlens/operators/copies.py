"""Distinct rows by one narrow sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def distinct_by(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, for a ``key`` that has few rows each, such as a patent.

    Rows are shuffled on the key alone, which joins on it before and after share, and copies are next to each other after
    a sort of narrow rows that may spill. ``distinct`` would keep every row of a file's slice, and again of a partition, in
    a hash table several times as large, though hardly any row has a copy.
    """
    others = [c for c in df.columns if c != key]
    group = Window.partitionBy(key).orderBy(*others)
    first = F.row_number().over(group) == 1
    copy = reduce(Column.__and__, (F.col(c).eqNullSafe(F.lag(c).over(group)) for c in others))
    seen = df.withColumns({"_first": first, "_copy": copy})
    return seen.filter(F.col("_first") | ~F.col("_copy")).drop("_first", "_copy")
