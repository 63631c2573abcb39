"""Wide and long forms of result-sized tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_counts(df: DataFrame, row: str, column: str, value: str, values: Sequence) -> DataFrame:
    """One column per listed value, zero where a cell is missing.

    The list is given by the caller: Spark then needs no extra pass to find it. A row with
    another value stops the job, so nothing is lost without a word.
    """
    listed = F.col(column).isin(*values) | F.col(column).isNull()
    known = F.when(listed, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"{column} holds an unlisted value: "), F.col(column).cast("string")))
    )
    df = df.withColumn(column, known)
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.sum(value))
    return wide.fillna(0, subset=[str(v) for v in values])


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str):
    return df.unpivot(list(ids), list(values), name, value)


def slim(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Keep and rename columns: {present name: new name}."""
    return df.select([F.col(old).alias(new) for old, new in columns.items()])
