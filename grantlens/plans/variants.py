"""Other forms of the standing questions, used by charts and the console report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from grantlens.functions.labels import coded_section_label, country_iso3, country_name
from grantlens.functions.numbers import compound_growth, growth, ratio, round4
from grantlens.functions.periods import DECADE_PERIODS, decade, open_period
from grantlens.operators.broadcasting import broadcast_if_bounded
from grantlens.operators.counting import count_ids
from grantlens.operators.growing import endpoints, split_year_sums
from grantlens.operators.ranking import top, top_per_group
from grantlens.operators.reshaping import pivot_counts
from grantlens.operators.shares import with_share, with_share_of
from grantlens.plans.analysis import period_counts
from grantlens.plans.summaries import Summaries
from grantlens.star import Star


def _with_name(df: DataFrame) -> DataFrame:
    return df.filter(F.col("name").isNotNull() & (F.trim("name") != ""))


def countries_top(summaries: Summaries, limit: int = 30) -> DataFrame:
    sums = summaries["mv_country_yearly"].groupBy("country").agg(F.sum("patents").alias("patents"))
    first = top(sums, [F.desc("patents"), F.asc("country")], limit)
    return first.withColumn("country_name", country_name(F.col("country"))).withColumn(
        "iso3", country_iso3(F.col("country"))
    )


def country_share_of_patents(star: Star, summaries: Summaries, limit: int = 5) -> DataFrame:
    """Shares in the number of patents, not in the sum of country counts."""
    sums = (
        summaries["mv_country_yearly"].groupBy("country").agg(F.sum("patents").alias("patent_count"))
    )
    size = star.patents.agg(F.count(F.lit(1)).alias("n"))
    shares = with_share_of(sums, "patent_count", size)
    return top(shares, [F.desc("patent_count"), F.asc("country")], limit)


def classes_top(star: Star, limit: int = 80) -> DataFrame:
    rows = star.class_rows.filter(F.col("section").isNotNull() & F.col("cpc_class").isNotNull())
    counts = count_ids(rows, ["section", "cpc_class"], "patent_id", "patents")
    first = top(counts, [F.desc("patents"), F.asc("section"), F.asc("cpc_class")], limit)
    return first.withColumn("section_label", coded_section_label(F.col("section")))


def section_trend(summaries: Summaries) -> DataFrame:
    """(year, section, patents), classes added up, with a short label."""
    sums = (
        summaries["mv_section_yearly"].groupBy("year", "section").agg(F.sum("patents").alias("patents"))
    )
    return sums.withColumn("section_label", coded_section_label(F.col("section"), 28)).orderBy(
        "year", "section"
    )


def _inventor_name_counts(star: Star, keep_blank: bool = False) -> DataFrame:
    people = star.inventors if keep_blank else _with_name(star.inventors)
    named = star.link_rows.select("patent_id", "inventor_id").join(
        people.select("inventor_id", F.col("name").alias("inventor"), "country"), "inventor_id"
    )
    return count_ids(named, ["inventor", "country"], "patent_id", "patents")


def inventors_by_name(star: Star, limit: int = 20) -> DataFrame:
    order = [F.desc("patents"), F.asc("inventor"), F.asc_nulls_last("country")]
    return top(_inventor_name_counts(star), order, limit)


def _company_name_counts(star: Star) -> DataFrame:
    owned = star.link_rows.filter(F.col("company_id").isNotNull())
    named = owned.select("patent_id", "company_id").distinct().join(
        _with_name(star.companies).select("company_id", F.col("name").alias("company")),
        "company_id",
    )
    return count_ids(named, ["company"], "patent_id", "patents")


def companies_by_name(star: Star, limit: int = 20) -> DataFrame:
    return top(_company_name_counts(star), [F.desc("patents"), F.asc("company")], limit)


def top_by_country(star: Star, k: int = 3) -> DataFrame:
    """(country, inventor, patents): the first k names of each country."""
    counts = _inventor_name_counts(star, keep_blank=True).filter(
        F.col("country").isNotNull() & F.col("inventor").isNotNull()
    )
    order = [F.desc("patents"), F.asc("inventor")]
    return top_per_group(counts, ["country"], order, k).orderBy(
        "country", F.desc("patents"), "inventor"
    )


def top_by_leading_country(star: Star, k: int = 3, countries: int = 12) -> DataFrame:
    """The same, only for the countries whose first k add up to most."""
    rows = top_by_country(star, k)
    sums = rows.groupBy("country").agg(F.sum("patents").alias("n"))
    leading = top(sums, [F.desc("n"), F.asc("country")], countries).select("country")
    kept = rows.join(broadcast_if_bounded(leading, countries), "country", "left_semi")
    return kept.orderBy("country", F.desc("patents"), "inventor")


def company_series(star: Star, leaders: int = 5) -> DataFrame:
    """(company, year, patents) of the leading names, from the facts."""
    names = companies_by_name(star, leaders).select("company")
    chosen = star.companies.select("company_id", F.col("name").alias("company")).join(
        broadcast_if_bounded(names, leaders), "company", "left_semi"
    )
    owned = star.activity.filter(F.col("company_id").isNotNull())
    rows = owned.select("patent_id", "company_id", "year").distinct().join(chosen, "company_id")
    return count_ids(rows, ["company", "year"], "patent_id", "patents").orderBy("year", "company")


def decade_volume(star: Star) -> DataFrame:
    rows = star.patents.filter(F.col("year").isNotNull()).groupBy(
        decade(F.col("year")).alias("decade")
    )
    return (
        rows.agg(F.count(F.lit(1)).alias("patents"))
        .withColumn("decade_label", F.concat(F.col("decade").cast("string"), F.lit("s")))
        .orderBy("decade")
    )


def company_cagr_by_name(summaries: Summaries, min_total: int = 10, limit: int = 15) -> DataFrame:
    """By company name; a single active year gives NULL. Growth rounded to four places."""
    named = summaries["mv_company_yearly"].filter(F.col("company").isNotNull())
    ends = endpoints(named, ["company"]).filter(F.col("total_patents") >= min_total)
    rate = compound_growth(
        F.col("first_year_patents"), F.col("last_year_patents"),
        F.col("last_year") - F.col("first_year"),
    )
    rows = ends.select(
        "company", "first_year", "last_year", "total_patents", round4(rate).alias("cagr")
    )
    return top(rows, [F.desc_nulls_last("cagr"), F.asc("company")], limit)


def country_split_year(
    summaries: Summaries, year: int = 2000, min_total: int = 50, limit: int = 25
) -> DataFrame:
    """(country, before, after, total, growth_pct): growth in percent across a year."""
    sums = split_year_sums(summaries["mv_country_yearly"], "country", year)
    rows = sums.withColumn("total", F.col("before") + F.col("after")).filter(
        F.col("total") >= min_total
    )
    first = top(rows, [F.desc("total"), F.asc("country")], limit)
    return first.withColumn(
        "growth_pct", round4(growth(F.col("after"), F.col("before")) * F.lit(100.0))
    ).withColumn("country_name", country_name(F.col("country")))


def section_split_year(
    summaries: Summaries, year: int = 2000, scale: float = 100.0, limit: int | None = None
) -> DataFrame:
    """(section, before, after, growth_pct); ``scale`` 1 gives a fraction instead of percent."""
    sums = split_year_sums(summaries["mv_section_yearly"], "section", year)
    rows = sums.withColumn(
        "growth_pct",
        round4(
            ratio((F.col("after") - F.col("before")) * F.lit(scale), F.col("before"))
        ),
    )
    return top(rows, [F.desc_nulls_last("growth_pct"), F.asc("section")], limit)


def company_section_by_name(star: Star, companies: int = 15) -> DataFrame:
    """(company, section, n) of the leading company names."""
    leaders = companies_by_name(star, companies).select("company")
    chosen = star.companies.select("company_id", F.col("name").alias("company")).join(
        broadcast_if_bounded(leaders, companies), "company", "left_semi"
    )
    owned = star.link_rows.filter(F.col("company_id").isNotNull()).select("patent_id", "company_id")
    owned = owned.distinct().join(chosen, "company_id").select("patent_id", "company").distinct()
    classes = star.class_rows.filter(F.col("section").isNotNull()).select("patent_id", "section")
    return count_ids(owned.join(classes, "patent_id"), ["company", "section"], "patent_id", "n")


def company_section_wide(star: Star, sections: list[str], companies: int = 15) -> DataFrame:
    return pivot_counts(
        company_section_by_name(star, companies), "company", "section", "n", sections
    )


def open_periods(star: Star) -> DataFrame:
    """Decades with open ends, and each one's share of all counted patents."""
    counts = period_counts(star, open_period(F.col("year"), DECADE_PERIODS))
    return with_share(counts, "patent_count").orderBy("period")
