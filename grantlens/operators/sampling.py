"""Deterministic stratified samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from grantlens.operators.ranking import top_per_group
from grantlens.operators.shares import everything


def proportional_quota(
    volumes: DataFrame, stratum: str, volume: str, peak: int, floor: int
) -> DataFrame:
    """Rows to take per stratum: scaled so the largest stratum gets ``peak``, never below ``floor``.

    ``volumes`` has one row per stratum. Ties of the rounding go to the even number.
    """
    largest = F.max(volume).over(everything())
    scaled = F.rint(F.col(volume).cast("double") / largest * F.lit(float(peak)))
    return volumes.select(stratum, F.greatest(F.lit(floor), scaled.cast("int")).alias("quota"))


def stratified_sample(
    df: DataFrame, quota: DataFrame, stratum: str, key: str, max_quota: int
) -> DataFrame:
    """The rows with the smallest hash of ``key`` in each stratum, as many as its quota.

    ``max_quota`` is the largest quota; no stratum sends more rows than that per
    task into the shuffle. The hash order is fixed by the key alone, so the
    sample does not depend on partitioning.
    """
    hashed = df.select(stratum, key, F.md5(F.col(key).cast("string")).alias("_hash"))
    kept = top_per_group(hashed, [stratum], [F.asc("_hash"), F.asc(key)], max_quota, "_position")
    chosen = kept.join(quota, stratum).filter(F.col("_position") <= F.col("quota"))
    # only keys go through the ranking; the rows are fetched for the chosen ones
    return df.join(chosen.select(stratum, key), [stratum, key], "left_semi")
