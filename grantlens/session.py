"""Session settings the library is tuned for.

Everything here is a default: on a cluster the submit-time configuration wins,
because ``builder.config`` values passed in ``extra`` are applied last.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A key that holds a large part of a join input is split into sub-partitions at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... also where the split costs another shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash instead of sort-merge joins where every partition of one side turns out small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    app: str = "grantlens", master: str | None = None, extra: dict | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local folder is chosen only when the session names none and runs on one machine;
    on a cluster every executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="grantlens-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")
