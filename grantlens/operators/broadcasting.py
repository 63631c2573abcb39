"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed bound: about a hundred bytes per row keeps the broadcast near ten megabytes.
MAX_BROADCAST_ROWS = 100_000


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when ``df`` cannot hold more than ``max_rows`` rows.

    ``max_rows`` must be a bound the plan itself enforces (a limit, a literal list).
    Beyond the bound no hint is given and Spark picks the join from run-time sizes.
    """
    return F.broadcast(df) if max_rows <= MAX_BROADCAST_ROWS else df
