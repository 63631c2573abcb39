"""Versions of stored tables, switched by one record.

Every build or refresh writes its files into folders of its own, ``<table>/<part>/version=<name>``, and names the
folders that make up each table in a commit record. The record is written last and put in place by one rename: readers
see the tables of one build or of the next, never a mixture, and a build that stops half way leaves files that
no record names. A part that did not change is named again, not copied, and an older snapshot stays readable until
``drop_unreferenced`` removes what the newest ones do not name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from grantlens.sources.paths import exists

_COMMITS = "_commits"
ROWS_PER_FILE = 20_000_000


class CommitConflict(RuntimeError):
    """Another build has committed since this one began."""


def _path(spark: SparkSession, name: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(name)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass
class Snapshot:
    """The tables of one commit: their schemas and the folders that hold their parts."""

    folder: str
    number: int = 0
    schemas: dict[str, str] = field(default_factory=dict)
    parts: dict[str, list[str]] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)  # rows the build wrote, by table

    def read(self, spark: SparkSession, table: str, only: list[str] | None = None) -> DataFrame:
        """A table, or some of its parts; folders of parts prune like partitions."""
        schema = StructType.fromJson(json.loads(self.schemas[table]))
        paths = [f"{self.folder}/{table}/{p}" for p in (self.parts[table] if only is None else only)]
        if not paths:
            return spark.createDataFrame([], schema)
        found = spark.read.schema(schema).option("basePath", f"{self.folder}/{table}").parquet(*paths)
        return found.select(schema.names)

    def next(self) -> Draft:
        """The start of the snapshot after this one: the same parts, to be replaced one by one."""
        copy = {table: list(parts) for table, parts in self.parts.items()}
        return Draft(self.folder, self.number + 1, dict(self.schemas), copy)


@dataclass
class Draft(Snapshot):
    """A snapshot in the making. Its files become visible with ``commit``."""

    version: str = ""

    def __post_init__(self):
        # a build that is run again must not meet the files of its first attempt
        self.version = self.version or f"{self.number:06d}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written aside and read back; not a part of any table."""
        target = f"{self.folder}/_work/{self.version}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(target)
        return df.sparkSession.read.schema(df.schema).parquet(target)

    def write(self, df: DataFrame, table: str, by: str | None = None) -> list[str]:
        """Write rows as new parts of a table, one for each value of ``by``; returns the parts."""
        spark, seen = df.sparkSession, Observation()
        self.schemas[table] = df.schema.json()
        root = f"{self.folder}/{table}"
        spread = df.hint("rebalance", F.col(by)) if by else df
        writer = (
            spread.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(self.version))
            .write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", ROWS_PER_FILE)
        )
        writer.partitionBy(*([by] if by else []), "version").parquet(root)
        self.written[table] = self.written.get(table, 0) + seen.get["rows"]
        ending = f"version={self.version}"
        if by is None:
            return [ending] if exists(spark, f"{root}/{ending}") else []
        target, system = _path(spark, root)
        names = (s.getPath().getName() for s in system.listStatus(target))
        return sorted(f"{n}/{ending}" for n in names if n.startswith(f"{by}=") and exists(spark, f"{root}/{n}/{ending}"))

    def replace(self, df: DataFrame, table: str, by: str | None = None) -> None:
        """The table from now on."""
        self.parts[table] = self.write(df, table, by)

    def append(self, df: DataFrame, table: str) -> list[str]:
        """More rows of a table whose parts are kept as they are; returns the new parts."""
        new = self.write(df, table)
        self.parts[table] = self.parts.get(table, []) + new
        return new

    def replace_parts(self, df: DataFrame, table: str, by: str, values: list) -> None:
        """The parts of some values of ``by``; those that get no rows are gone."""
        gone = {part_name(by, v) for v in values}
        kept = [p for p in self.parts[table] if PurePosixPath(p).parts[0] not in gone]
        self.parts[table] = sorted(kept + self.write(df, table, by))

    def of_values(self, table: str, by: str, values: list) -> list[str]:
        """The parts that hold some values of ``by``."""
        wanted = {part_name(by, v) for v in values}
        return [p for p in self.parts[table] if PurePosixPath(p).parts[0] in wanted]

    def commit(self, spark: SparkSession) -> Snapshot:
        """Put the record in place, or fail where another build has taken the number."""
        record = {"schemas": self.schemas, "parts": self.parts, "written": self.written}
        final = f"{self.folder}/{_COMMITS}/{self.number:06d}.json"
        aside, system = _path(spark, f"{self.folder}/{_COMMITS}/.{self.version}")
        stream = system.create(aside, False)
        stream.write(json.dumps(record).encode())
        stream.close()
        target, _ = _path(spark, final)
        # a rename onto a file that exists fails by itself on shared stores; a local disk would replace it
        if system.exists(target) or not system.rename(aside, target):
            system.delete(aside, False)
            raise CommitConflict(final)
        return Snapshot(self.folder, self.number, self.schemas, self.parts, self.written)


def part_name(by: str, value) -> str:
    return f"{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the committed snapshots, ascending."""
    target, system = _path(spark, f"{folder}/{_COMMITS}")
    if not system.exists(target):
        return []
    names = (s.getPath().getName() for s in system.listStatus(target))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def snapshot(spark: SparkSession, folder: str, number: int | None = None) -> Snapshot | None:
    """The newest snapshot, or the one of a number; nothing where nothing was committed."""
    known = numbers(spark, folder)
    if not known:
        return None
    chosen = known[-1] if number is None else number
    text = spark.read.text(f"{folder}/{_COMMITS}/{chosen:06d}.json", wholetext=True).first()[0]
    return Snapshot(folder, chosen, **json.loads(text))


def draft(spark: SparkSession, folder: str) -> Draft:
    """An empty snapshot with the next number."""
    return Draft(folder, (numbers(spark, folder) or [0])[-1] + 1)


def drop_unreferenced(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete files that none of the newest ``keep`` snapshots names; returns how many folders went.

    Not to be run beside a build: its files are named by no record yet.
    """
    known = numbers(spark, folder)
    kept = [snapshot(spark, folder, n) for n in known[-keep:]]
    named = {f"{table}/{p}" for s in kept for table, parts in s.parts.items() for p in parts}
    root, system = _path(spark, folder)
    gone = 0
    for number in known[:-keep]:
        system.delete(_path(spark, f"{folder}/{_COMMITS}/{number:06d}.json")[0], False)
    for table in {t for s in kept for t in s.parts}:
        for found in system.globStatus(_path(spark, f"{folder}/{table}/{{version=*,*/version=*}}")[0]) or []:
            name = found.getPath().toUri().getPath().split(root.toUri().getPath().rstrip("/") + "/", 1)[1]
            if name not in named:
                gone += system.delete(found.getPath(), True)
    system.delete(_path(spark, f"{folder}/_work")[0], True)
    return gone
