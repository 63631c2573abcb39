"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.session import shared_folder

# What separates words, as a pattern and as bytes.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"

# The setting that lets Spark remove a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the folder all executors share, and read back.

    A result that several later steps read is computed once this way, and a lost executor
    costs nothing that has been written. The folder is left for the owner to clear, because
    frames that read it may still be evaluated later. Shuffle files of the write go when it ends: nothing
    reads them again, and otherwise they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/corpus/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """128 bits that stand for a text (null: the empty text)."""
    return F.unhex(F.md5(text_or_empty(column)))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per different text: key, text, n_rows.

    Copies meet map-side first, so a text that a third of all rows repeat reaches its reducer as
    one row per task.
    """
    return (
        docs.select(text_key().alias("key"), text_or_empty().alias("text"))
        .groupBy("key")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n_rows"))
    )
