"""File-system questions answered through Hadoop's API, so any store Spark can reach works."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file; one that exists stays as it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(target)


def _files(spark: SparkSession, folder: str) -> Iterator[tuple[str, int]]:
    """Path and length of every file below a folder (or of the file itself)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    while found.hasNext():
        status = found.next()
        yield status.getPath().toString(), status.getLen()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files Spark would read at a path: hidden and empty ones are left out."""
    found = (file for file, size in _files(spark, path) if size)
    return sorted(f for f in found if f.rsplit("/", 1)[-1][0] not in "._")


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, bytes) of the files below a folder, empty ones too. Only metadata is read.

    The driver lists names, as Spark does for every scan; contents are left to the tasks.
    """
    rows = [
        (path, size) for path, size in _files(spark, folder) if fnmatch(path.rsplit("/", 1)[-1], pattern)
    ]
    return spark.createDataFrame(rows, "path string, bytes long")
