"""Checks of keys, references and value ranges; each returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent. NULL keys refer to nothing and are no orphans."""
    present = child.filter(F.col(key).isNotNull())
    return present.join(parent.select(key), key, "left_anti")


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def failures(df: DataFrame, table: str, check: str, bad: Column | None = None) -> DataFrame:
    """(table_name, check_name, failures): how many rows break a rule."""
    counted = F.count(F.lit(1)) if bad is None else F.count_if(bad)
    return df.agg(counted.alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "failures"
    )


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
