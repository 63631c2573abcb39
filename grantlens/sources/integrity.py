"""File manifests: is every recorded file there, whole and unchanged; what is still to load."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

MANIFEST = StructType([
    StructField("path", StringType()),
    StructField("bytes", LongType()),
    StructField("sha256", StringType()),
])

# Which folder prefixes each format choice selects.
FORMAT_PREFIXES = {
    "parquet": ("parquet/",),
    "csv": ("csv/",),
    "warehouse": ("warehouse/",),
    "both": ("parquet/", "csv/"),
    "all": ("parquet/", "csv/", "warehouse/"),
}

_BLOCK = 1 << 20


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) rows from a JSON document whose ``files`` field maps path to facts."""
    facts = StructType([MANIFEST["bytes"], MANIFEST["sha256"]])
    document = StructType([StructField("files", MapType(StringType(), facts))])
    return (
        spark.read.schema(document)
        .option("multiLine", "true")
        .json(path)
        .select(F.explode("files").alias("path", "facts"))
        .select("path", "facts.bytes", "facts.sha256")
    )


def choose_format(manifest: DataFrame, kind: str) -> DataFrame:
    wanted = F.lit(False)
    for prefix in FORMAT_PREFIXES[kind]:
        wanted = wanted | F.col("path").startswith(prefix)
    return manifest.filter(wanted)


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        sums = []
        for path in batch["path"]:
            system, inner = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with system.open_input_stream(inner) as stream:
                while block := stream.read(_BLOCK):
                    digest.update(block)
            sums.append(digest.hexdigest())
        yield batch.assign(sha256=sums)


def checksums(files: DataFrame) -> DataFrame:
    """Add the SHA-256 of each listed file, read in blocks by the task that holds its row.

    The digest of one file is sequential by nature; files are spread over tasks.
    """
    spread = files.select("path", "bytes").repartition("path")
    return spread.mapInPandas(_hash_files, "path string, bytes long, sha256 string")


def _hash_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        sums = []
        for path, at, size in zip(batch["path"], batch["at"], batch["size"], strict=True):
            system, inner = fs.FileSystem.from_uri(path)
            digest, left = hashlib.sha256(), int(size)
            with system.open_input_file(inner) as stream:
                stream.seek(int(at))
                while left and (block := stream.read(min(left, _BLOCK))):
                    digest.update(block)
                    left -= len(block)
            if left:
                raise OSError(f"{path} is shorter than listed")
            sums.append(digest.digest())
        yield batch.assign(digest=sums)


def tree_checksums(files: DataFrame, block_bytes: int = 256 << 20) -> DataFrame:
    """Add ``tree_sha256``: the SHA-256 of the SHA-256 digests of a file's blocks, in their order.

    Blocks of one file are hashed by different tasks, so a file of any size takes no longer than a block. The value
    depends on ``block_bytes``; an empty file has one empty block.
    """
    blocks = files.select(
        "path", "bytes",
        F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("bytes") / block_bytes) - 1))).alias("block"),
    )
    parts = blocks.select(
        "path", "bytes", "block", (F.col("block") * block_bytes).alias("at"),
        F.least(F.lit(block_bytes).cast("long"), F.col("bytes") - F.col("block") * block_bytes).alias("size"),
    ).repartition("path", "block")
    hashed = parts.mapInPandas(_hash_blocks, "path string, bytes long, block long, at long, size long, digest binary")
    # a digest per block: 32 bytes for every 256 MB
    ordered = F.array_sort(F.collect_list(F.struct("block", F.hex("digest").alias("digest"))))
    return hashed.groupBy("path", "bytes").agg(
        F.sha2(F.unhex(F.concat_ws("", F.transform(ordered, lambda b: b["digest"]))), 256).alias("tree_sha256"))


def audit(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status): ok, missing or mismatch, for every manifest row.

    ``found`` has (path, bytes, sha256) with paths in the manifest's form.
    """
    actual = found.select(
        "path", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256")
    )
    same = (F.col("bytes") == F.col("_bytes")) & (F.col("sha256") == F.col("_sha256"))
    status = (
        F.when(F.col("_sha256").isNull(), F.lit("missing"))
        .when(same, F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return manifest.join(actual, "path", "left").select("path", status.alias("status"))


def read_load_record(spark: SparkSession, path: str) -> DataFrame:
    """Files recorded as loaded. An absent or malformed record counts as empty."""
    from grantlens.sources.paths import exists

    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).option("mode", "DROPMALFORMED").json(path)
    return rows.filter(F.col("path").isNotNull())


def pending(found: DataFrame, recorded: DataFrame, force: bool = False) -> DataFrame:
    """Files to load: not recorded, or recorded with another size; all of them when forced."""
    if force:
        return found
    done = recorded.select("path", "bytes").dropDuplicates()
    return found.join(done, ["path", "bytes"], "left_anti")


def record_loaded(files: DataFrame, path: str) -> None:
    files.select("path", "bytes", "sha256").write.mode("append").json(path)
