"""A trigram index for substring search, so that a search reads only texts that may hold its needle.

Texts are stored by year and slice, a few megabytes of text each, a slice to a folder. The index holds, for each run
of three characters, the slices in which some lower-cased title or abstract has it, sorted by the run. A needle
is taken apart at its wildcards; slices that hold all runs of its literal pieces are the candidates, and Spark prunes
the folders of all others when the join with them runs. The exact test then sees the rows of candidates only. A
needle without a literal piece of three characters has all slices as candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from grantlens.functions.text import matches
from grantlens.operators.broadcasting import broadcast_if_bounded

RUN = 3
SLICE_BYTES = 8 << 20

# Columns of the stored texts and runs.
TEXTS = ["patent_id", "title", "abstract", "filing_date", "year", "slice"]
RUNS = "run string, year int, slice int"

_BITS = 21  # of a character
_BREAK = np.array([0x110000], dtype="<u4")  # stands between texts; no character has this number
_MANY_SIGNS = 1 << 20  # characters whose runs are told apart at a time


def runs_of(text: Column) -> Column:
    """The different runs of three characters of a text, lower-cased; ``_slice_runs`` finds them for many texts at once."""
    # bound once as the element of an array; written out inside the inner function it would be split anew per character
    longer = F.transform(
        F.array(F.split(F.lower(text), "")),
        lambda signs: F.transform(signs, lambda c, i: F.concat(c, F.get(signs, i + 1), F.get(signs, i + 2))),
    )
    # past the end an element is NULL, and so is the run
    return F.array_distinct(F.filter(F.get(longer, 0), lambda r: r.isNotNull()))


def _different_runs(texts: list[np.ndarray]) -> list[str]:
    """The different runs of texts given by the numbers of their characters."""
    signs = np.concatenate([part for text in texts for part in (text, _BREAK)]).astype(np.int64)
    inside = signs < _BREAK[0]
    whole = inside[:-2] & inside[1:-1] & inside[2:]
    packed = np.unique((signs[:-2] << 2 * _BITS | signs[1:-1] << _BITS | signs[2:])[whole])
    mask = (1 << _BITS) - 1
    parts = np.stack([packed >> 2 * _BITS, packed >> _BITS & mask, packed & mask], axis=1).astype("<u4")
    text = parts.tobytes().decode("utf-32-le")
    return [text[k:k + RUN] for k in range(0, len(text), RUN)]


def _slice_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (year, slice, lower-cased text); a slice repeats a run only after very many characters."""
    place, texts, signs = None, [], 0

    def found() -> pa.RecordBatch:
        runs = _different_runs(texts)
        kept = [pa.array([v] * len(runs), pa.int32()) for v in place]
        return pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), *kept], names=["run", "year", "slice"])

    for batch in batches:
        for year, part, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if texts and ((year, part) != place or signs > _MANY_SIGNS):
                yield found()
                texts, signs = [], 0
            place = (year, part)
            for start in range(0, len(text) - RUN + 1, _MANY_SIGNS):  # pieces of a long text overlap
                if signs > _MANY_SIGNS:
                    yield found()
                    texts, signs = [], 0
                texts.append(np.frombuffer(text[start:start + _MANY_SIGNS + RUN - 1].encode("utf-32-le"), dtype="<u4"))
                signs += len(texts[-1])
    if texts:
        yield found()


def needle_runs(needle: str, literal: bool = False) -> list[str]:
    """Runs that every text with the needle holds.

    A literal needle is lowered by Spark, a pattern here; where the two might differ a run is left out.
    """
    pieces = [needle.lower()] if literal else re.split("[%_]", needle.lower())
    found = {p[k:k + RUN] for p in pieces for k in range(len(p) - RUN + 1)}
    return sorted(r for r in found if not literal or r.isascii())


@dataclass(frozen=True)
class TextIndex:
    """A stored index; ``slices`` bounds the candidates of any search."""

    spark: SparkSession
    folder: str
    slices: int
    schema: StructType

    @property
    def texts(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/texts")

    def candidates(self, runs: list[str], window: Column) -> DataFrame:
        """(year, slice) of the slices that hold all of ``runs``."""
        postings = self.spark.read.schema(RUNS).parquet(f"{self.folder}/runs")
        found = postings.filter(F.col("run").isin(runs) & window)
        return found.groupBy("year", "slice").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(runs)).select("year", "slice")

    def hits(self, needle: str, window: Column, literal: bool = False) -> DataFrame:
        """Patents inside the year window whose title or abstract holds the needle."""
        rows, runs = self.texts.filter(window), needle_runs(needle, literal)
        if runs:
            candidates = broadcast_if_bounded(self.candidates(runs, window), self.slices)
            rows = rows.join(candidates, ["year", "slice"], "left_semi")
        found = matches(F.col("title"), needle, literal) | matches(F.col("abstract"), needle, literal)
        return rows.filter(found).select("patent_id", "title", "abstract", "filing_date", "year")


def build_index(patents: DataFrame, folder: str, slice_bytes: int = SLICE_BYTES) -> TextIndex:
    """Lay the patents out by year and slice, and write the runs of each slice."""
    spark = patents.sparkSession
    size = F.octet_length(F.coalesce("title", F.lit(""))) + F.octet_length(F.coalesce("abstract", F.lit("")))
    years = patents.groupBy("year").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(size.cast("long")) / slice_bytes)).cast("int").alias("slices"))
    rows = patents.select("patent_id", "title", "abstract", "filing_date", "year").alias("p").join(
        broadcast_if_bounded(years.alias("y"), 1000), F.expr("p.year <=> y.year")  # a row per year
    ).select("p.*", "slices")
    placed = rows.withColumn("slice", F.pmod(F.xxhash64("patent_id"), F.col("slices")).cast("int"))
    text = f"{folder}/texts"
    (
        placed.select(TEXTS).repartition("year", "slice")
        .write.mode("overwrite").option("compression", "zstd").partitionBy("year", "slice").parquet(text)
    )
    schema = placed.select(TEXTS).schema
    stored = spark.read.schema(schema).parquet(text)
    held = F.lower(F.concat_ws("\n", "title", "abstract"))
    runs = stored.select("year", "slice", held.alias("held")).mapInArrow(_slice_runs, RUNS).distinct()
    (
        runs.repartitionByRange("run").sortWithinPartitions("run", "year", "slice").select("run", "year", "slice")
        .write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/runs")
    )
    return open_index(spark, folder, schema)


def open_index(spark: SparkSession, folder: str, schema: StructType) -> TextIndex:
    """A stored index; ``schema`` gives the types of TEXTS."""
    slices = spark.read.schema(schema).parquet(f"{folder}/texts").select("year", "slice").distinct().count()
    return TextIndex(spark, folder, slices, schema)
