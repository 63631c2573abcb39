"""Delimited text: tolerant about NULL tokens, strict about everything else."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from grantlens.schemas import RAW, RAW_FILES
from grantlens.sources.paths import data_files, exists

# Texts that stand for a missing value in raw files.
NULL_TOKENS = ("", "NULL", "null")

_QUOTING = {"quote": '"', "escape": '"'}
# Spark's writer would cut blanks at both ends of a value.
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def without_null_tokens(c: str) -> Column:
    column = F.col(c)
    return F.when(~column.isin(*NULL_TOKENS), column).alias(c)


def header_of(spark: SparkSession, path: str, separator: str = "\t") -> list[str]:
    """Column names of a delimited file, from its first line only."""
    return spark.read.option("sep", separator).option("header", "true").csv(path).columns


def scan(
    spark: SparkSession,
    path: str,
    schema: StructType,
    separator: str = "\t",
    multiline: bool = False,
) -> DataFrame:
    """All-text scan with a header. A malformed row stops the job.

    Each file's own header decides which of the schema's columns are present and in
    which order; columns it lacks come back as NULL. Files of a folder are read in groups
    of one header. Ids keep leading zeros
    because no type is inferred. ``multiline`` is for files with line breaks inside
    quotes; such files cannot be split between tasks, so it is off by default.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in data_files(spark, path):
        groups.setdefault(tuple(header_of(spark, file, separator)), []).append(file)
    if not groups:
        raise FileNotFoundError(f"no data files at {path}")
    parts = [
        _scan_alike(spark, files, list(names), schema, separator, multiline)
        for names, files in groups.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _scan_alike(
    spark: SparkSession, files: list[str], names: list[str], schema: StructType,
    separator: str, multiline: bool,
) -> DataFrame:
    """Files that share one header."""
    present = StructType.fromDDL(", ".join(f"`{n}` string" for n in names))
    raw = (
        spark.read.schema(present)
        .option("sep", separator)
        .option("header", "true")
        .options(**_QUOTING)
        .option("multiLine", multiline)
        # With pruning, a row of the wrong length would pass whenever few columns are read.
        .option("columnPruning", "false")
        .option("mode", "FAILFAST")
        # The header is compared with the names: a file of another order stops the job.
        .option("enforceSchema", "false")
        .csv(files)
    )
    return raw.select(
        [
            without_null_tokens(f.name)
            if f.name in names
            else F.lit(None).cast("string").alias(f.name)
            for f in schema
        ]
    )


def scan_optional(
    spark: SparkSession, path: str, schema: StructType, separator: str = "\t"
) -> DataFrame:
    """Like ``scan``; an absent file gives an empty table with the right columns."""
    if exists(spark, path):
        return scan(spark, path, schema, separator)
    return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw tables. Locations and classifications may be absent."""
    optional = {"locations", "cpc"}
    return {
        name: (scan_optional if name in optional else scan)(
            spark, f"{folder.rstrip('/')}/{file}", RAW[name]
        )
        for name, file in RAW_FILES.items()
    }


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header and ISO dates. ``files`` is for result-sized tables only."""
    out = df if files is None else df.coalesce(files)
    (
        out.write.mode("overwrite")
        .option("header", "true")
        .option("dateFormat", "yyyy-MM-dd")
        .options(**_QUOTING, **_KEEP_SPACES)
        .csv(path)
    )


def write_tsv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("sep", "\t")
        .options(**_QUOTING, **_KEEP_SPACES)
        .option("emptyValue", "")
        .csv(path)
    )
