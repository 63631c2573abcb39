"""A small representative sample of a star, and its raw layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.functions.text import after_first_word, first_word
from grantlens.operators.numbering import number_within
from grantlens.operators.sampling import proportional_quota, stratified_sample
from grantlens.operators.shares import everything
from grantlens.star import Star

PEAK_PER_YEAR = 200
MIN_PER_YEAR = 25


def quota_from_volumes(
    spark: SparkSession, volumes: dict[int, int], peak: int = PEAK_PER_YEAR, floor: int = MIN_PER_YEAR
) -> DataFrame:
    """(year, quota) from a caller's list of yearly volumes."""
    rows = spark.createDataFrame(list(volumes.items()), "year int, patents long")
    return proportional_quota(rows, "year", "patents", peak, floor)


def quota_from_data(star: Star, peak: int = PEAK_PER_YEAR, floor: int = MIN_PER_YEAR) -> DataFrame:
    """(year, quota) in proportion to the data's own yearly volume."""
    return proportional_quota(star.yearly, "year", "patents", peak, floor)


def sample_patents(
    star: Star,
    quota: DataFrame | None = None,
    peak: int = PEAK_PER_YEAR,
    floor: int = MIN_PER_YEAR,
) -> DataFrame:
    """Patents chosen by the hash of their id, per year as many as the quota says.

    A given quota bounds itself: its largest entry is looked up, one row per year.
    """
    if quota is None:
        chosen, most = quota_from_data(star, peak, floor), max(peak, floor)
    else:
        chosen, most = quota, quota.agg(F.max("quota")).first()[0] or 0
    dated = star.patents.filter(F.col("year").isNotNull())
    return stratified_sample(dated, chosen, "year", "patent_id", most)


def sample_audit(sample: DataFrame) -> DataFrame:
    """Rows per year, next to the sample's size and range of years."""
    whole = everything()  # one row per year
    return (
        sample.groupBy("year")
        .agg(F.count(F.lit(1)).alias("patents"))
        .withColumn("sample_size", F.sum("patents").over(whole))
        .withColumn("first_year", F.min("year").over(whole))
        .withColumn("last_year", F.max("year").over(whole))
        .orderBy("year")
    )


def country_locations(star: Star) -> DataFrame:
    """One made-up location id per two-letter country."""
    codes = star.inventors.filter(F.length(F.trim("country")) == 2).select("country").distinct()
    return codes.select("country", F.concat(F.lit("loc_"), F.lower("country")).alias("location_id"))


def raw_patents(sample: DataFrame) -> DataFrame:
    return sample.select(
        "patent_id",
        F.lit("utility").alias("patent_type"),
        F.date_format("filing_date", "yyyy-MM-dd").alias("patent_date"),
        F.col("title").alias("patent_title"),
        F.lit("B2").alias("wipo_kind"),
        F.lit(None).cast("int").alias("num_claims"),
        F.lit(0).alias("withdrawn"),
        F.lit(None).cast("string").alias("filename"),
    )


def _of_sample(df: DataFrame, sample: DataFrame) -> DataFrame:
    return df.join(sample.select("patent_id"), "patent_id", "left_semi")


def raw_inventors(star: Star, sample: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per sampled link, numbered within its patent."""
    people = star.inventors.withColumnRenamed("name", "full_name")
    rows = (
        _of_sample(star.links, sample)
        .join(people, "inventor_id")
        .join(locations, "country", "left")
        .select("patent_id", "inventor_id", "company_id", "full_name", "location_id")
    )
    numbered = number_within(rows, "patent_id", ["inventor_id", "company_id"], "inventor_sequence")
    return numbered.select(
        "patent_id",
        "inventor_sequence",
        "inventor_id",
        first_word(F.col("full_name")).alias("disambig_inventor_name_first"),
        after_first_word(F.col("full_name")).alias("disambig_inventor_name_last"),
        F.lit(None).cast("string").alias("gender_code"),
        "location_id",
    )


def raw_assignees(star: Star, sample: DataFrame) -> DataFrame:
    rows = _of_sample(star.links.filter(F.col("company_id").isNotNull()), sample).join(
        star.companies, "company_id"
    )
    numbered = number_within(rows, "patent_id", ["company_id", "inventor_id"], "assignee_sequence")
    nothing = F.lit(None).cast("string")
    return numbered.select(
        "patent_id",
        "assignee_sequence",
        F.col("company_id").alias("assignee_id"),
        nothing.alias("disambig_assignee_individual_name_first"),
        nothing.alias("disambig_assignee_individual_name_last"),
        F.col("name").alias("disambig_assignee_organization"),
        F.lit("2").alias("assignee_type"),
        nothing.alias("location_id"),
    )


def raw_locations(locations: DataFrame) -> DataFrame:
    nothing = F.lit(None)
    return locations.select(
        "location_id",
        nothing.cast("string").alias("disambig_city"),
        nothing.cast("string").alias("disambig_state"),
        F.col("country").alias("disambig_country"),
        nothing.cast("double").alias("latitude"),
        nothing.cast("double").alias("longitude"),
        nothing.cast("string").alias("county"),
        nothing.cast("string").alias("state_fips"),
        nothing.cast("string").alias("county_fips"),
    )


def raw_cpc(star: Star, sample: DataFrame) -> DataFrame:
    rows = _of_sample(star.cpc, sample)
    numbered = number_within(
        rows, "patent_id", ["section", "cpc_class", "cpc_subclass"], "cpc_sequence"
    )
    return numbered.select(
        "patent_id",
        "cpc_sequence",
        F.col("section").alias("cpc_section"),
        "cpc_class",
        "cpc_subclass",
        F.lit(None).cast("string").alias("cpc_group"),
        F.lit("inventional").alias("cpc_type"),
    )


def sample_raw_layout(star: Star, sample: DataFrame) -> dict[str, DataFrame]:
    """The five raw tables rebuilt for the sampled patents."""
    locations = country_locations(star)
    return {
        "patents": raw_patents(sample),
        "inventors": raw_inventors(star, sample, locations),
        "assignees": raw_assignees(star, sample),
        "locations": raw_locations(locations),
        "cpc": raw_cpc(star, sample),
    }
