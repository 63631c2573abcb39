"""Load each raw file once.

The file source's checkpoint is the record of what has been loaded: a restarted
run takes up only files it has not seen, and the Parquet sink's commit log keeps
a retried batch from being written twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from grantlens.sources.delimited import without_null_tokens


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Append the rows of unseen tab-separated files to ``target``."""
    raw = (
        spark.readStream.schema(schema)
        .option("sep", "\t")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        # A file whose header differs from the schema stops the load; no value lands in another's column.
        .option("enforceSchema", "false")
        .option("columnPruning", "false")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
    )
    cleaned = raw.select([without_null_tokens(f.name) for f in schema])
    query = (
        cleaned.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
