"""The fourteen standing questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from grantlens.functions.labels import section_label
from grantlens.functions.numbers import growth, round4
from grantlens.functions.periods import FIVE_YEAR_PERIODS, closed_period
from grantlens.operators.broadcasting import broadcast_if_bounded
from grantlens.operators.counting import count_ids, count_rows, entity_counts, entity_years
from grantlens.operators.growing import (
    HALVES,
    compound_growth_table,
    half_growth,
    midpoint,
    two_sided_counts,
    with_previous,
)
from grantlens.operators.ranking import top, top_per_group
from grantlens.operators.shares import everything, with_share
from grantlens.star import Star


def top_inventors(star: Star, limit: int = 20) -> DataFrame:
    counts = entity_counts(star, star.inventors, "inventor_id", "patent_count")
    rows = counts.select(
        "inventor_id", F.col("name").alias("inventor_name"), "country", "patent_count"
    )
    order = [F.desc("patent_count"), F.asc_nulls_last("inventor_name"), F.asc("inventor_id")]
    return top(rows, order, limit)


def top_companies(star: Star, limit: int = 20) -> DataFrame:
    counts = entity_counts(star, star.companies, "company_id", "patent_count")
    rows = counts.select("company_id", F.col("name").alias("company_name"), "patent_count")
    order = [F.desc("patent_count"), F.asc_nulls_last("company_name"), F.asc("company_id")]
    return top(rows, order, limit)


def country_counts(star: Star) -> DataFrame:
    """Distinct patents per inventor country."""
    return count_rows(star.patents_in_countries(), ["country"], "patent_count")


def country_share(star: Star, limit: int = 15) -> DataFrame:
    """A patent counts once in each of its countries, also in the total."""
    shares = with_share(country_counts(star), "patent_count")
    return top(shares, [F.desc("patent_count"), F.asc("country")], limit)


def yearly_trend(star: Star) -> DataFrame:
    return star.yearly.withColumnRenamed("patents", "patent_count").orderBy("year")


def _newest_documents(star: Star, documents: DataFrame, limit: int) -> DataFrame:
    """The patents the first ``limit`` link rows belong to: at most ``limit`` of them.

    Every link of a complete star survives the joins, so no other patent can reach the result.
    """
    front = (
        star.dated_links.select("year", "patent_id")
        .orderBy(F.desc_nulls_last("year"), F.asc("patent_id"))
        .limit(limit)
        .select("patent_id")
        .distinct()
    )
    kept = documents.join(broadcast_if_bounded(front, limit), "patent_id", "left_semi")
    return broadcast_if_bounded(kept, limit)


def wide_join(star: Star, limit: int = 500) -> DataFrame:
    """Newest rows of patents with their inventors and, where known, companies.

    Company names are looked up for the kept rows only.
    """
    order = [
        F.desc_nulls_last("year"),
        F.asc("patent_id"),
        F.asc_nulls_last("inventor_name"),
        F.asc("inventor_id"),
        F.asc_nulls_last("company_id"),
    ]
    people = star.inventors.select(
        "inventor_id", F.col("name").alias("inventor_name"), F.col("country").alias("inventor_country")
    )
    documents = star.patents.select(
        "patent_id", F.col("title").alias("patent_title"), "filing_date", "year"
    )
    if star.complete:
        documents = _newest_documents(star, documents, limit)
    newest = star.links.join(documents, "patent_id").join(people, "inventor_id")
    newest = newest.orderBy(*order).limit(limit)
    names = star.companies.select("company_id", F.col("name").alias("company_name"))
    return (
        newest.join(names, "company_id", "left")
        .orderBy(*order)
        .select(
            "patent_id", "patent_title", "filing_date", "year", "inventor_name",
            "inventor_country", "company_name",
        )
    )


def reference_year(yearly: DataFrame, share_of_peak: float = 0.6):
    """Latest year whose volume reaches the given part of the peak, as a scalar subquery."""
    peak = F.max("patents").over(everything())
    full = yearly.withColumn("peak", peak).filter(
        F.col("patents") >= F.col("peak") * F.lit(share_of_peak)
    )
    return full.agg(F.max("year")).scalar()


def innovation_leaders(star: Star, min_patents: int = 2, limit: int = 20) -> DataFrame:
    """Companies by growth in the latest complete year over their previous active year."""
    counted = entity_years(star, "company_id", "patents_filed")
    compared = with_previous(counted, ["company_id"], "patents_filed", "prev_year_patents")
    current = compared.filter(
        (F.col("year") == reference_year(star.yearly)) & (F.col("patents_filed") >= min_patents)
    )
    filed, previous = F.col("patents_filed"), F.col("prev_year_patents")
    rows = (
        current.join(star.companies, "company_id")
        .withColumn("yoy_delta", filed - F.coalesce(previous, F.lit(0)))
        .withColumn("yoy_growth_pct", round4(growth(filed, previous)))
        .withColumnRenamed("name", "company_name")
    )
    order = [F.desc_nulls_last("yoy_growth_pct"), F.desc("patents_filed"), F.asc("company_id")]
    return top(rows, order, limit).select(
        "company_name", "year", "patents_filed", "prev_year_patents", "yoy_delta", "yoy_growth_pct"
    )


def top_inventors_by_country(star: Star, k: int = 3) -> DataFrame:
    """First k inventors of each country, with the rank that ties share.

    Every row ahead of a kept row is kept too, so the rank may be taken after the cut.
    """
    counts = entity_counts(
        star, star.inventors.filter(F.col("country").isNotNull() & (F.col("country") != "")),
        "inventor_id", "patent_count",
    ).withColumnRenamed("name", "inventor_name")
    order = [F.desc("patent_count"), F.asc_nulls_last("inventor_name"), F.asc("inventor_id")]
    kept = top_per_group(counts, ["country"], order, k)
    rank = F.rank().over(Window.partitionBy("country").orderBy(F.desc("patent_count")))
    return (
        kept.withColumn("country_rank", rank)
        .orderBy("country", "country_rank", F.asc_nulls_last("inventor_name"), "inventor_id")
        .select("country", "country_rank", "inventor_name", "patent_count")
    )


def period_counts(star: Star, label) -> DataFrame:
    """Patents, inventors and companies per period; patents without links count too.

    The patents are counted on their own (their key is unique). The other two
    distinct counts share one pass over the links.
    """
    patents = (
        star.patents.filter(F.col("year").isNotNull())
        .groupBy(label.alias("period"))
        .agg(F.count(F.lit(1)).alias("patent_count"))
    )
    others = star.activity.groupBy(label.alias("period")).agg(
        F.count_distinct("inventor_id").alias("inventor_count"),
        F.count_distinct("company_id").alias("company_count"),
    )
    return (
        patents.join(others, "period", "left")
        .fillna(0, subset=["inventor_count", "company_count"])
        .select("period", "patent_count", "inventor_count", "company_count")
    )


def period_comparison(
    star: Star, periods: Sequence[tuple[int, int]] = tuple(FIVE_YEAR_PERIODS)
) -> DataFrame:
    low, high = min(p[0] for p in periods), max(p[1] for p in periods)
    inside = F.col("year").between(low, high)
    narrowed = Star(
        star.patents.filter(inside), star.inventors, star.companies, star.links, star.cpc,
        dated_links=star.activity.filter(inside),
    )
    counts = period_counts(narrowed, closed_period(F.col("year"), periods))
    counts = counts.filter(F.col("period") != "other")
    return with_share(counts, "patent_count").orderBy("period")


def company_cagr(
    star: Star, min_total: int = 20, min_span: int = 3, limit: int | None = 25
) -> DataFrame:
    """Compound yearly growth between a company's first and last active year."""
    yearly = entity_years(star, "company_id")
    rates = compound_growth_table(yearly, ["company_id"], min_total, min_span)
    rows = rates.join(star.companies, "company_id").withColumnRenamed("name", "company_name")
    order = [F.desc_nulls_last("cagr"), F.desc("total_patents"), F.asc("company_id")]
    ranked = top(rows, order, limit) if limit is not None else rows
    return ranked.select(
        "company_name", "first_year", "last_year", "span_years", "first_year_patents",
        "last_year_patents", "total_patents", "cagr",
    )


def country_halves(star: Star) -> DataFrame:
    placed = star.patents_in_countries(dated=True)
    return two_sided_counts(placed, "country", F.col("year") <= midpoint(star.patents), HALVES)


def section_halves(star: Star) -> DataFrame:
    classed = star.patents_in_sections(dated=True)
    return two_sided_counts(classed, "section", F.col("year") <= midpoint(star.patents), HALVES)


def country_growth(star: Star, min_total: int = 30, limit: int | None = 25) -> DataFrame:
    rows = half_growth(country_halves(star)).filter(F.col("total_patents") >= min_total)
    order = [F.desc_nulls_last("growth_pct"), F.desc("total_patents"), F.asc("country")]
    return top(rows, order, limit)


def section_growth(star: Star) -> DataFrame:
    order = [F.desc_nulls_last("growth_pct"), F.desc("total_patents"), F.asc("section")]
    return half_growth(section_halves(star)).orderBy(*order)


def company_section_counts(star: Star, leaders: DataFrame, max_leaders: int) -> DataFrame:
    """Patents per (company_name, section) for a bounded list of companies.

    ``leaders`` has (company_id, company_name). Companies of one name share their rows.
    """
    rows = star.link_rows.select("patent_id", "company_id")
    owned = rows.join(broadcast_if_bounded(leaders, max_leaders), "company_id")
    # The leaders' inventors would multiply the pairs; drop copies before meeting the classes.
    owned = owned.select("patent_id", "company_name").distinct()
    classes = star.class_rows.filter(F.col("section").isNotNull()).select("patent_id", "section")
    return count_ids(
        owned.join(classes, "patent_id"), ["company_name", "section"], "patent_id", "patents"
    )


def company_section_matrix(star: Star, companies: int = 15) -> DataFrame:
    counts = entity_counts(star, star.companies, "company_id", "n")
    leaders = top(
        counts, [F.desc("n"), F.asc_nulls_last("name"), F.asc("company_id")], companies
    ).select("company_id", F.col("name").alias("company_name"))
    return company_section_counts(star, leaders, companies).orderBy("company_name", "section")


def totals(star: Star) -> DataFrame:
    """One row: table sizes and the range of years."""
    def size(df):
        return df.agg(F.count(F.lit(1))).scalar()

    return star.patents.agg(
        F.count(F.lit(1)).alias("total_patents"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
    ).select(
        "total_patents",
        size(star.inventors).alias("total_inventors"),
        size(star.companies).alias("total_companies"),
        size(star.links).alias("total_relationships"),
        "year_min",
        "year_max",
    )


def section_breakdown(star: Star) -> DataFrame:
    counts = count_rows(star.patents_in_sections(), ["section"], "patent_count")
    return counts.withColumn("section_label", section_label(F.col("section"))).orderBy(
        F.desc("patent_count"), "section"
    )


QUESTIONS = {
    "top_inventors": top_inventors,
    "top_companies": top_companies,
    "country_share": country_share,
    "yearly_trend": yearly_trend,
    "wide_join": wide_join,
    "innovation_leaders": innovation_leaders,
    "top_inventors_by_country": top_inventors_by_country,
    "period_comparison": period_comparison,
    "company_cagr": company_cagr,
    "country_growth": country_growth,
    "section_growth": section_growth,
    "company_section_matrix": company_section_matrix,
    "totals": totals,
    "section_breakdown": section_breakdown,
}


def answer_all(star: Star) -> dict[str, DataFrame]:
    """Every standing question, as lazy DataFrames."""
    return {name: question(star) for name, question in QUESTIONS.items()}


def run_sql(star: Star, text: str, args: dict | None = None) -> DataFrame:
    """A SQL text over the five tables, with bound parameters.

    Tables are named as placeholders in braces, e.g. ``SELECT * FROM {patents} WHERE year = :y``.
    """
    tables = {
        "patents": star.patents,
        "inventors": star.inventors,
        "companies": star.companies,
        "patent_relationships": star.links,
        "patent_cpc": star.cpc,
    }
    used = {name: df for name, df in tables.items() if "{" + name + "}" in text}
    return star.patents.sparkSession.sql(text, args=args or {}, **used)
