"""The twelve summary tables, and routines that store and audit them.

By-name tables merge entities that share a name, as the dashboards expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.functions.periods import DECADE_PERIODS
from grantlens.operators.counting import count_patents, count_patents_by_label, count_rows
from grantlens.operators.quality import report
from grantlens.operators.ranking import top
from grantlens.plans.analysis import (
    company_cagr,
    company_section_counts,
    country_halves,
    period_comparison,
    section_halves,
)
from grantlens.sources.snapshots import Snapshot
from grantlens.sources.warehouse import write_counted
from grantlens.star import Star

# Companies of the stored company x section matrix.
MATRIX_COMPANIES = 50


def yearly(star: Star) -> DataFrame:
    return star.yearly


def country_yearly(star: Star) -> DataFrame:
    return count_rows(star.patents_in_countries(dated=True), ["country", "year"], "patents")


def section_yearly(star: Star) -> DataFrame:
    return count_patents(star.classified, ["section", "cpc_class", "year"])


def _lifetime(star: Star, key: str) -> DataFrame:
    """Patents and active years per entity id, from one row per (entity, patent)."""
    return star.patents_of(key, dated=True).groupBy(key).agg(
        F.count(F.lit(1)).alias("total_patents"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def company_total(star: Star) -> DataFrame:
    names = star.companies.select("company_id", F.col("name").alias("company"))
    return names.join(_lifetime(star, "company_id"), "company_id")


def inventor_total(star: Star) -> DataFrame:
    people = star.inventors.select(
        "inventor_id",
        F.col("name").alias("inventor"),
        F.coalesce("country", F.lit("?")).alias("country"),
    )
    return people.join(_lifetime(star, "inventor_id"), "inventor_id")


def company_yearly(star: Star) -> DataFrame:
    named = star.companies.select("company_id", F.col("name").alias("company"))
    return count_patents_by_label(star.pair_rows("company_id"), named, "company_id", ["company"]).select(
        "company", "year", "patents"
    )


def inventor_yearly(star: Star) -> DataFrame:
    people = star.inventors.select("inventor_id", F.col("name").alias("inventor"), "country")
    counted = count_patents_by_label(star.pair_rows("inventor_id"), people, "inventor_id", ["inventor", "country"])
    return counted.select("inventor", F.coalesce("country", F.lit("?")).alias("country"), "year", "patents")


def company_section(star: Star, companies: int = MATRIX_COMPANIES) -> DataFrame:
    order = [F.desc("total_patents"), F.asc_nulls_last("company"), F.asc("company_id")]
    leaders = top(company_total(star), order, companies).select(
        "company_id", F.col("company").alias("company_name")
    )
    return company_section_counts(star, leaders, companies)


def decade_compare(star: Star) -> DataFrame:
    return period_comparison(star, DECADE_PERIODS)


def country_halfsplit(star: Star) -> DataFrame:
    """A patent lies in one half only, so the two halves add up to the distinct total."""
    halves = country_halves(star)
    total = F.col("first_half_patents") + F.col("second_half_patents")
    return halves.withColumn("total_patents", total)


def section_halfsplit(star: Star) -> DataFrame:
    return section_halves(star)


def company_growth(star: Star, min_total: int = 20, min_span: int = 3) -> DataFrame:
    return company_cagr(star, min_total, min_span, limit=None)


SUMMARIES = {
    "mv_yearly": yearly,
    "mv_country_yearly": country_yearly,
    "mv_section_yearly": section_yearly,
    "mv_company_total": company_total,
    "mv_inventor_total": inventor_total,
    "mv_company_yearly": company_yearly,
    "mv_inventor_yearly": inventor_yearly,
    "mv_company_section": company_section,
    "mv_decade_compare": decade_compare,
    "mv_country_halfsplit": country_halfsplit,
    "mv_section_halfsplit": section_halfsplit,
    "mv_company_cagr": company_growth,
}

# The clean tables each summary is made from; links bring patents, inventors and companies, classes bring patents.
MADE_FROM = {
    "mv_yearly": ("patents",),
    "mv_country_yearly": ("links",),
    "mv_section_yearly": ("cpc",),
    "mv_company_total": ("links",),
    "mv_inventor_total": ("links",),
    "mv_company_yearly": ("links",),
    "mv_inventor_yearly": ("links",),
    "mv_company_section": ("links", "cpc"),
    "mv_decade_compare": ("links",),
    "mv_country_halfsplit": ("links",),
    "mv_section_halfsplit": ("cpc",),
    "mv_company_cagr": ("links",),
}

# The summaries that grow with the data and are read by year window.
BY_YEAR = {"mv_company_yearly", "mv_inventor_yearly"}


class Summaries:
    """Summary tables by name: those of a snapshot or a folder when one is given, else derived on demand."""

    def __init__(self, star: Star, folder: str | None = None, snapshot: Snapshot | None = None):
        self._star = star
        self._folder = folder
        self._snapshot = snapshot

    def __getitem__(self, name: str) -> DataFrame:
        if self._folder is None and self._snapshot is None:
            return SUMMARIES[name](self._star)
        spark = self._star.patents.sparkSession
        if self._snapshot is not None:
            return self._snapshot.read(spark, name)
        return spark.read.parquet(f"{self._folder}/{name}")


def write_summaries(star: Star, folder: str) -> dict[str, int]:
    """Rebuild every summary; returns the rows written to each."""
    return {
        name: write_counted(build(star), f"{folder}/{name}", by_year=name in BY_YEAR)
        for name, build in SUMMARIES.items()
    }


def audit_stored(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, rows) of the stored summaries."""
    return report([
        spark.read.parquet(f"{folder}/{name}")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows")
        for name in SUMMARIES
    ])
