"""Top-k, top-k per group, paging and sort choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Spark prunes a row_number() filter before the shuffle up to this many rows per group
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_PRUNED = 1000


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, number: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group.

    For k up to the pruning threshold Spark's WindowGroupLimit keeps at most k
    rows per group and task before the shuffle. Above it the groups are first cut
    down inside hash-salted sub-groups, which keeps every row that can still be
    among the first k.
    """
    column = number or "_position"
    if k > GROUP_LIMIT_PRUNED:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_within", F.row_number().over(inner))
            .filter(F.col("_within") <= k)
            .drop("_within", "_salt")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(column, F.row_number().over(window)).filter(F.col(column) <= k)
    return ranked if number else ranked.drop(column)


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, [key], order, 1)


def ranked_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, name: str
) -> DataFrame:
    """Rows whose rank (ties share one) is at most ``limit``; ties may exceed the limit."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.rank().over(window)).filter(F.col(name) <= limit)


def top(df: DataFrame, order: Sequence[Column], limit: int | None) -> DataFrame:
    """Sorted rows, the first ``limit`` of them when given."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def page(df: DataFrame, order: Sequence[Column], size: int, offset: int = 0) -> DataFrame:
    """One page; ``order`` must end in a unique key for pages to be stable."""
    return df.orderBy(*order).offset(offset).limit(size)


def page_count(total: int, size: int) -> int:
    return max(1, -(-total // size))


def page_offset(total: int, size: int, number: int) -> int:
    """Offset of page ``number`` (from 0), held inside the existing pages."""
    return max(0, min(number, page_count(total, size) - 1)) * size


def sort_choice(choice: str, count: str, name: str, tie: Sequence[str]) -> list[Column]:
    """Orderings a user can pick, always completed by the tie columns."""
    orders = {
        "count_desc": [F.desc_nulls_last(count)],
        "count_asc": [F.asc_nulls_last(count)],
        "name_asc": [F.asc_nulls_last(name)],
        "name_desc": [F.desc_nulls_last(name)],
    }
    if choice not in orders:
        raise ValueError(f"unknown sort {choice!r}; one of {sorted(orders)}")
    return orders[choice] + [F.asc_nulls_last(c) for c in tie]
