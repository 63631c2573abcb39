"""Exact distinct counts for any set of filters, from stored bitmaps instead of facts.

Patents get gap-free numbers inside their year, inventors and companies over all. For every country, and for every
section and class, a bitmap says which patents of a year it has; for every country and year, bitmaps say which
inventors and companies were active. Bitmaps of 32768 numbers each are joined by OR for the chosen countries,
classes and years and by AND across kinds of filters, so a patent in several countries or classes counts once,
and a query reads a few kilobytes per value and year whatever the number of links behind them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantlens.operators.dense import dense_numbers
from grantlens.plans.filtered import Filters
from grantlens.star import Star, country_present


def bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bucket, bits) of the numbers in ``rows``; repeated numbers set a bit once.

    Numbers are shuffled, not bitmaps: every task would make one of four kilobytes for each key and bucket it meets, and
    both tasks and buckets grow with the rows. A key's bucket has as many rows as numbers, times their repetitions.
    """
    number = F.col("number")
    placed = rows.select(*keys, F.bitmap_bucket_number(number + 1).alias("bucket"), F.bitmap_bit_position(number + 1).alias("place"))
    return placed.repartition(*keys, "bucket").groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def write_bitmaps(star: Star, folder: str) -> None:
    """Store the bitmaps of a star."""
    spark = star.patents.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    dated = star.patents.filter(F.col("year").isNotNull()).select("patent_id", "year")
    patents = kept(dense_numbers(dated, "patent_id", by="year"), "patent_numbers")
    kept(bitmaps(patents, ["year"]), "patents")
    numbered = patents.select("patent_id", "number")
    kept(bitmaps(star.patents_in_countries(dated=True).join(numbered, "patent_id"), ["country", "year"]), "patents_by_country")
    classes = star.dated_class_rows.filter(F.col("year").isNotNull()).join(numbered, "patent_id")
    kept(bitmaps(classes, ["section", "cpc_class", "year"]), "patents_by_class")

    people = kept(dense_numbers(star.inventors.select("inventor_id"), "inventor_id"), "inventor_numbers")
    owners = kept(dense_numbers(star.companies.select("company_id"), "company_id"), "company_numbers")
    places = star.inventors.select("inventor_id", "country")
    # an entity is active in a year by many links: one row of them is kept before numbers are joined
    active = star.activity.select("inventor_id", "year").distinct().join(places.join(people, "inventor_id"), "inventor_id")
    kept(bitmaps(active, ["country", "year"]), "inventors")
    owned = star.activity.filter(F.col("company_id").isNotNull()).join(places, "inventor_id", "left")
    owned = owned.select("company_id", "country", "year").distinct().join(owners, "company_id")
    kept(bitmaps(owned, ["country", "year"]), "companies")


class Bitmaps:
    """Stored bitmaps, and the counts they give under filters."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def _read(self, name: str, f: Filters) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}").filter(f.in_window())

    def _sides(self, f: Filters) -> list[DataFrame]:
        """(year, bucket, bits) of the patents that satisfy each kind of filter."""
        chosen = []
        if f.countries:
            chosen.append(self._read("patents_by_country", f).filter(F.col("country").isin(*f.countries)))
        if f.by_class:
            chosen.append(self._read("patents_by_class", f).filter(f.class_condition()))
        return [_merged(df, ["year"]) for df in chosen or [self._read("patents", f)]]

    def yearly(self, f: Filters) -> DataFrame:
        """(year, patents): patents that satisfy every filter, each counted once."""
        return _counted(_in_all(self._sides(f), ["year"]), ["year"], "patents").orderBy("year")

    def countries(self, f: Filters) -> DataFrame:
        """(country, patents) under all filters."""
        where = country_present()
        if f.countries:
            where = where & F.col("country").isin(*f.countries)
        places = _merged(self._read("patents_by_country", f).filter(where), ["country", "year"])
        if f.by_class:
            chosen = _merged(self._read("patents_by_class", f).filter(f.class_condition()), ["year"])
            places = _in_all([places, chosen.join(places.select("country", "year", "bucket"), ["year", "bucket"])],
                             ["country", "year"])
        return _counted(places, ["country"], "patents").orderBy(F.desc("patents"), "country")

    def sections(self, f: Filters) -> DataFrame:
        """(section, patents): a patent with several classes of a section counts once in it."""
        rows = self._read("patents_by_class", f).filter(f.class_condition() & F.col("section").isNotNull())
        merged = _merged(rows, ["section", "year"])
        if f.countries:
            places = _merged(self._read("patents_by_country", f).filter(F.col("country").isin(*f.countries)), ["year"])
            merged = _in_all([merged, places.join(merged.select("section", "year", "bucket"), ["year", "bucket"])],
                             ["section", "year"])
        return _counted(merged, ["section"], "patents").orderBy(F.desc("patents"), "section")

    def overview(self, f: Filters) -> DataFrame:
        """One row of distinct patents, inventors, companies and countries in a window and some countries."""
        if f.by_class:
            raise ValueError("who filed in a class is not kept per class: use filtered.overview")
        where = F.col("country").isin(*f.countries) if f.countries else F.lit(True)
        active = self._read("inventors", f).filter(where)
        patents = self.yearly(f).agg(F.coalesce(F.sum("patents"), F.lit(0)).alias("n"))
        inventors = _counted(_merged(active, []), [], "n")
        companies = _counted(_merged(self._read("companies", f).filter(where), []), [], "n")
        return active.agg(F.count_distinct("country").alias("countries")).select(
            patents.scalar().alias("patents"), inventors.scalar().alias("inventors"),
            companies.scalar().alias("companies"), "countries",
        )


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One bitmap per key and bucket: numbers that any row has."""
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _in_all(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """One bitmap per key and bucket: numbers that every side has."""
    columns = [*keys, "bucket", "bits"]
    if len(sides) == 1:
        return sides[0]
    both = reduce(DataFrame.unionByName, (s.select(columns) for s in sides))
    met = both.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("_n"))
    return met.filter(F.col("_n") == len(sides)).drop("_n")


def _counted(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    total: Column = F.sum(F.bitmap_count("bits"))
    counts = rows.groupBy(*keys).agg((total if keys else F.coalesce(total, F.lit(0))).alias(name))
    return counts.filter(F.col(name) > 0) if keys else counts
