"""Views under user filters.

Two routes answer the same question where both are exact. The summary route
reads tables of result size; the base route reads the facts with semi joins, so
a filter never multiplies rows. Where a summary route is *not* exact (distinct
counts summed over countries or classes count a patent more than once) it has
its own function, named ``..._rollup``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.functions.labels import country_iso3, country_name, section_label
from grantlens.functions.numbers import (
    direction_text,
    growth,
    ratio,
    round4,
    signed_percent_text,
)
from grantlens.functions.text import matches, preview, shortened
from grantlens.operators.broadcasting import broadcast_if_bounded
from grantlens.operators.counting import count_ids
from grantlens.operators.growing import trend
from grantlens.operators.ranking import page, ranked_within, sort_choice, top
from grantlens.operators.reshaping import pivot_counts, unpivot
from grantlens.operators.shares import concentration, with_share
from grantlens.plans.search import TextIndex
from grantlens.plans.summaries import MATRIX_COMPANIES, Summaries
from grantlens.star import Star, country_present

# Named year ranges. A negative start counts back from the last year.
PRESETS = {
    "All time": (None, None),
    "Last 5 yrs": (-5, None),
    "1970s": (1970, 1979),
    "1980s": (1980, 1989),
    "1990s": (1990, 1999),
    "2000s": (2000, 2009),
    "2010s": (2010, 2019),
    "2020s": (2020, None),
}


@dataclass(frozen=True)
class Filters:
    """What the user chose. Empty tuples mean no restriction."""

    first_year: int
    last_year: int
    countries: tuple[str, ...] = ()
    sections: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    top_n: int = 20
    min_patents: int = 1

    @property
    def by_class(self) -> bool:
        return bool(self.sections or self.classes)

    def in_window(self) -> Column:
        return F.col("year").between(self.first_year, self.last_year)

    def class_condition(self) -> Column:
        chosen = F.lit(True)
        if self.sections:
            chosen = chosen & F.col("section").isin(*self.sections)
        if self.classes:
            chosen = chosen & F.col("cpc_class").isin(*self.classes)
        return chosen

    def with_country(self, clicked: str | None) -> Filters:
        """Add a country picked in another view; already chosen ones stay as they are."""
        if not clicked or clicked in self.countries:
            return self
        return replace(self, countries=(*self.countries, clicked))


def resolve_preset(name: str, low: int, high: int) -> tuple[int, int]:
    """Year range of a preset inside the data's own bounds; an unknown name means everything."""
    start, end = PRESETS.get(name, (None, None))
    if start is None:
        first = low
    elif start < 0:
        first = max(low, high + start)
    else:
        first = max(low, start)
    return first, high if end is None else min(high, end)


def preset_window(star: Star, name: str) -> DataFrame:
    """The patents of a preset, its bounds taken from the data without a separate job."""
    known = star.patents.filter(F.col("year").isNotNull())
    low, high = known.agg(F.min("year")).scalar(), known.agg(F.max("year")).scalar()
    start, end = PRESETS.get(name, (None, None))
    if start is None:
        first = low
    elif start < 0:
        first = F.greatest(low, high + F.lit(start))
    else:
        first = F.greatest(low, F.lit(start))
    last = high if end is None else F.least(high, F.lit(end))
    return known.filter((F.col("year") >= first) & (F.col("year") <= last))


# -- building blocks ----------------------------------------------------------------------


def _classified_only(df: DataFrame, star: Star, f: Filters) -> DataFrame:
    """Keep patents that have a chosen classification."""
    if not f.by_class:
        return df
    chosen = star.class_rows.filter(f.class_condition()).select("patent_id")
    return df.join(chosen, "patent_id", "left_semi")


def _in_countries(df: DataFrame, star: Star, f: Filters) -> DataFrame:
    """Keep link rows whose inventor lives in a chosen country."""
    if not f.countries:
        return df
    chosen = star.inventors.filter(F.col("country").isin(*f.countries)).select("inventor_id")
    return df.join(chosen, "inventor_id", "left_semi")


def _links(star: Star, f: Filters, *columns: str) -> DataFrame:
    """Links in the window whose patent has a chosen class."""
    rows = star.activity.filter(f.in_window()).select("patent_id", *columns)
    return _classified_only(rows, star, f)


# -- yearly volume ------------------------------------------------------------------------


def yearly(star: Star, f: Filters) -> DataFrame:
    """(year, patents): patents that satisfy every filter, each counted once."""
    rows = _classified_only(
        star.patents.filter(f.in_window()).select("patent_id", "year"), star, f
    )
    if f.countries:
        placed = _in_countries(star.link_rows.select("patent_id", "inventor_id"), star, f)
        rows = rows.join(placed.select("patent_id"), "patent_id", "left_semi")
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("patents")).orderBy("year")


def yearly_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """From summaries. With several countries a patent counts once in each of them."""
    if not f.countries:
        return (
            summaries["mv_yearly"].filter(f.in_window()).select("year", "patents").orderBy("year")
        )
    rows = summaries["mv_country_yearly"].filter(
        f.in_window() & F.col("country").isin(*f.countries)
    )
    return rows.groupBy("year").agg(F.sum("patents").alias("patents")).orderBy("year")


def trends(star: Star, f: Filters) -> DataFrame:
    """Yearly volume with change, running total, direction and label."""
    rows = trend(yearly(star, f))
    known = F.col("yoy").isNotNull()
    return (
        rows.withColumn("direction", F.when(known, direction_text(F.col("yoy"))))
        .withColumn("label", F.when(known, signed_percent_text(F.col("yoy"))))
        .orderBy("year")
    )


def latest_change(star: Star) -> DataFrame:
    """One row: the last two years with data, their counts and the change."""
    last_two = star.yearly.orderBy(F.desc("year")).limit(2)
    pair = last_two.agg(
        F.max("year").alias("year"),
        F.max_by("patents", "year").alias("patents"),
        F.when(F.count(F.lit(1)) == 2, F.min_by("patents", "year")).alias("previous"),
    )
    return pair.withColumn("yoy", round4(growth(F.col("patents"), F.col("previous"))))


# -- countries ----------------------------------------------------------------------------


def countries(star: Star, f: Filters) -> DataFrame:
    """(country, patents) under all filters."""
    where = country_present()
    if f.countries:
        where = where & F.col("country").isin(*f.countries)
    places = star.inventors.filter(where).select("inventor_id", "country")
    placed = _links(star, f, "inventor_id").join(places, "inventor_id")
    counts = count_ids(placed, ["country"], "patent_id", "patents")
    return counts.orderBy(F.desc("patents"), "country")


def countries_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """From summaries; the country filter is not applied (all countries stay comparable).

    Exact: within one country a patent has one year.
    """
    rows = summaries["mv_country_yearly"].filter(f.in_window())
    counts = rows.groupBy("country").agg(F.sum("patents").alias("patents"))
    return counts.orderBy(F.desc("patents"), "country")


def geography(counts: DataFrame) -> DataFrame:
    """Share, name and ISO-3 code next to (country, patents)."""
    return (
        with_share(counts, "patents")
        .withColumn("country_name", country_name(F.col("country")))
        .withColumn("iso3", country_iso3(F.col("country")))
        .orderBy(F.desc("patents"), "country")
    )


def geography_concentration(counts: DataFrame) -> DataFrame:
    return concentration(counts, "country", "patents", (3, 10))


# -- inventors and companies --------------------------------------------------------------


def inventor_volumes(star: Star, f: Filters) -> DataFrame:
    """(inventor, country, patents) with at least ``min_patents`` in the window."""
    people = star.inventors.select("inventor_id", F.col("name").alias("inventor"), "country")
    if f.countries:
        people = people.filter(F.col("country").isin(*f.countries))
    named = _links(star, f, "inventor_id").join(people, "inventor_id")
    counts = count_ids(named, ["inventor", "country"], "patent_id", "patents")
    return counts.filter(F.col("patents") >= f.min_patents).withColumn(
        "country", F.coalesce("country", F.lit("?"))
    )


def inventor_volumes_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """The same from the by-name yearly summary; exact, as years do not overlap."""
    rows = summaries["mv_inventor_yearly"].filter(f.in_window())
    if f.countries:
        rows = rows.filter(F.col("country").isin(*f.countries))
    sums = rows.groupBy("inventor", "country").agg(F.sum("patents").alias("patents"))
    return sums.filter(F.col("patents") >= f.min_patents)


def company_volumes(star: Star, f: Filters) -> DataFrame:
    """(company, patents) with at least ``min_patents`` in the window."""
    rows = star.activity.filter(f.in_window() & F.col("company_id").isNotNull())
    rows = _in_countries(rows, star, f).select("patent_id", "company_id").distinct()
    rows = _classified_only(rows, star, f)
    names = star.companies.select("company_id", F.col("name").alias("company"))
    counts = count_ids(rows.join(names, "company_id"), ["company"], "patent_id", "patents")
    return counts.filter(F.col("patents") >= f.min_patents)


def company_volumes_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    rows = summaries["mv_company_yearly"].filter(f.in_window())
    sums = rows.groupBy("company").agg(F.sum("patents").alias("patents"))
    return sums.filter(F.col("patents") >= f.min_patents)


def volumes_page(
    volumes: DataFrame, name: str, f: Filters, sort: str = "count_desc", offset: int = 0
) -> DataFrame:
    """One page of a leaderboard; all grouping columns break ties, so pages do not overlap."""
    tie = [c for c in volumes.columns if c != "patents"]
    return page(volumes, sort_choice(sort, "patents", name, tie), f.top_n, offset)


def volumes_total(volumes: DataFrame) -> DataFrame:
    return volumes.agg(F.count(F.lit(1)).alias("n"))


def route_inventors(star: Star, summaries: Summaries, f: Filters) -> DataFrame:
    """Summary when it can answer, facts when a classification is chosen."""
    return inventor_volumes(star, f) if f.by_class else inventor_volumes_rollup(summaries, f)


def route_companies(star: Star, summaries: Summaries, f: Filters) -> DataFrame:
    if f.by_class or f.countries:
        return company_volumes(star, f)
    return company_volumes_rollup(summaries, f)


def ranked_inventors(star: Star, f: Filters, rank: int = 3) -> DataFrame:
    """(country, inventor, patents, rnk) with rnk up to ``rank``; ties may give more rows."""
    where = country_present()
    if f.countries:
        where = where & F.col("country").isin(*f.countries)
    people = star.inventors.filter(where).select(
        "inventor_id", F.col("name").alias("inventor"), "country"
    )
    named = _links(star, f, "inventor_id").join(people, "inventor_id")
    counts = count_ids(named, ["country", "inventor"], "patent_id", "patents")
    ranked = ranked_within(counts, ["country"], [F.desc("patents")], rank, "rnk")
    return ranked.orderBy("country", "rnk", F.asc_nulls_last("inventor"))


def leader_series(star: Star, summaries: Summaries, f: Filters, leaders: int = 8) -> DataFrame:
    """(year, company, patents) of the first ``leaders`` companies on the first page."""
    first = volumes_page(
        route_companies(star, summaries, f), "company", replace(f, top_n=leaders)
    ).select("company")
    rows = summaries["mv_company_yearly"].filter(f.in_window())
    series = rows.join(broadcast_if_bounded(first, leaders), "company", "left_semi")
    return series.select("year", "company", "patents").orderBy("year", "company")


# -- overview -----------------------------------------------------------------------------


def overview(star: Star, f: Filters) -> DataFrame:
    """One row of distinct counts by id under all filters."""
    rows = star.activity.filter(f.in_window())
    rows = _in_countries(_classified_only(rows, star, f), star, f)
    # An id counts only when its entity is known.
    people = star.inventors.select("inventor_id", "country")
    present = rows.select("inventor_id").distinct().join(people, "inventor_id")
    owners = rows.select("company_id").distinct().join(
        star.companies.select("company_id"), "company_id", "left_semi"
    )
    return present.agg(
        F.count(F.lit(1)).alias("inventors"), F.count_distinct("country").alias("countries")
    ).select(
        yearly(star, f).agg(F.coalesce(F.sum("patents"), F.lit(0))).scalar().alias("patents"),
        "inventors",
        owners.agg(F.count(F.lit(1))).scalar().alias("companies"),
        "countries",
    )


def overview_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """One row from summaries: distinct *names*; countries filter only patents and countries."""
    inside = f.in_window()
    places = summaries["mv_country_yearly"].filter(inside)
    if f.countries:
        places = places.filter(F.col("country").isin(*f.countries))
    names = summaries["mv_inventor_yearly"].filter(inside)
    owners = summaries["mv_company_yearly"].filter(inside)
    return names.agg(F.count_distinct("inventor").alias("inventors")).select(
        yearly_rollup(summaries, f)
        .agg(F.coalesce(F.sum("patents"), F.lit(0)))
        .scalar()
        .alias("patents"),
        "inventors",
        owners.agg(F.count_distinct("company")).scalar().alias("companies"),
        places.agg(F.count_distinct("country")).scalar().alias("countries"),
    )


# -- classifications ----------------------------------------------------------------------


def _class_rows(star: Star, f: Filters) -> DataFrame:
    rows = star.classified.filter(f.in_window() & f.class_condition())
    if f.countries:
        placed = _in_countries(star.link_rows.select("patent_id", "inventor_id"), star, f)
        rows = rows.join(placed.select("patent_id"), "patent_id", "left_semi")
    return rows


def classes(star: Star, f: Filters) -> DataFrame:
    """(section, cpc_class, patents, section_label)."""
    counts = count_ids(_class_rows(star, f), ["section", "cpc_class"], "patent_id", "patents")
    return counts.withColumn("section_label", section_label(F.col("section")))


def classes_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """From summaries, without the country filter; exact for a fixed class."""
    rows = summaries["mv_section_yearly"].filter(f.in_window() & f.class_condition())
    sums = rows.groupBy("section", "cpc_class").agg(F.sum("patents").alias("patents"))
    return sums.withColumn("section_label", section_label(F.col("section")))


def section_sums(class_counts: DataFrame) -> DataFrame:
    """Sections as the sum of their classes: a patent in two classes counts twice."""
    return (
        class_counts.groupBy("section", "section_label")
        .agg(F.sum("patents").alias("patents"))
        .orderBy(F.desc("patents"), "section")
    )


def class_tree(class_counts: DataFrame) -> DataFrame:
    """Totals at three levels: everything, section, class. ``depth`` is 0, 1 or 2."""
    # grouping_id is 3 for the grand total, 1 for a section, 0 for a class.
    depth = F.when(F.grouping_id() == 3, 0).when(F.grouping_id() == 1, 1).otherwise(2)
    return class_counts.rollup("section_label", "cpc_class").agg(
        F.sum("patents").alias("patents"), depth.alias("depth")
    )


def section_years(star: Star, f: Filters) -> DataFrame:
    """(year, section, patents), each patent once per section."""
    counts = count_ids(_class_rows(star, f), ["year", "section"], "patent_id", "patents")
    return counts.orderBy("year", "section")


def section_years_rollup(summaries: Summaries, f: Filters) -> DataFrame:
    """From summaries: all sections, as the sum of their classes."""
    rows = summaries["mv_section_yearly"].filter(f.in_window())
    sums = rows.groupBy("year", "section").agg(F.sum("patents").alias("patents"))
    return sums.orderBy("year", "section")


# -- advanced views -----------------------------------------------------------------------


def decade_view(summaries: Summaries) -> DataFrame:
    return summaries["mv_decade_compare"].select(
        "period",
        F.col("patent_count").alias("patents"),
        F.col("inventor_count").alias("inventors"),
        F.col("company_count").alias("companies"),
        "share",
    ).orderBy("period")


def cagr_view(summaries: Summaries, f: Filters) -> DataFrame:
    order = [F.desc_nulls_last("cagr"), F.desc("total_patents"), F.asc_nulls_last("company_name")]
    return top(summaries["mv_company_cagr"], order, f.top_n)


def _halves_growth(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "growth", ratio(F.col("second_half") - F.col("first_half"), F.col("first_half"))
    )


def country_growth_view(summaries: Summaries, min_total: int = 30) -> DataFrame:
    rows = summaries["mv_country_halfsplit"].filter(F.col("total_patents") >= min_total).select(
        "country",
        country_name(F.col("country")).alias("country_name"),
        F.col("first_half_patents").alias("first_half"),
        F.col("second_half_patents").alias("second_half"),
        "total_patents",
    )
    return _halves_growth(rows).orderBy(F.desc_nulls_last("growth"), "country")


def section_growth_view(summaries: Summaries) -> DataFrame:
    """Sections with a known growth."""
    rows = summaries["mv_section_halfsplit"].select(
        "section",
        section_label(F.col("section")).alias("section_label"),
        F.col("first_half_patents").alias("first_half"),
        F.col("second_half_patents").alias("second_half"),
    )
    grown = _halves_growth(rows).filter(F.col("growth").isNotNull())
    return grown.withColumn("label", signed_percent_text(F.col("growth"))).orderBy(
        "growth", "section"
    )


def section_growth_long(summaries: Summaries) -> DataFrame:
    return unpivot(
        section_growth_view(summaries), ["section_label"], ["first_half", "second_half"],
        "half", "patents",
    )


def heatmap(summaries: Summaries, sections: Sequence[str], companies: int = 15) -> DataFrame:
    """Wide company x section table of the leading companies.

    The summary holds so many companies and no more: asking for others is an error.
    """
    if companies > MATRIX_COMPANIES:
        raise ValueError(f"the stored matrix holds {MATRIX_COMPANIES} companies")
    order = [F.desc("total_patents"), F.asc_nulls_last("company"), F.asc("company_id")]
    leaders = top(summaries["mv_company_total"], order, companies).select(
        F.col("company").alias("company_name")
    )
    cells = summaries["mv_company_section"].join(
        broadcast_if_bounded(leaders, companies), "company_name", "left_semi"
    )
    return pivot_counts(cells, "company_name", "section", "patents", sections)


# -- search -------------------------------------------------------------------------------


def _hits(patents: DataFrame, needle: str, f: Filters, literal: bool, index: TextIndex | None) -> DataFrame:
    if index is not None:
        return index.hits(needle, f.in_window(), literal)
    found = matches(F.col("title"), needle, literal) | matches(F.col("abstract"), needle, literal)
    return patents.filter(f.in_window() & found)


def search_count(
    star: Star, needle: str, f: Filters, literal: bool = False, index: TextIndex | None = None
) -> DataFrame:
    """How many patents hold the needle; ``index`` is one of the star's patents."""
    return _hits(star.patents, needle, f, literal, index).agg(F.count(F.lit(1)).alias("n"))


def search_page(
    star: Star, needle: str, f: Filters, size: int = 50, offset: int = 0, literal: bool = False,
    index: TextIndex | None = None,
) -> DataFrame:
    """Newest hits first, with the start of the abstract."""
    rows = _hits(star.patents, needle, f, literal, index).select(
        "patent_id", "title", "year", "filing_date", preview(F.col("abstract")).alias("abstract_preview")
    )
    return page(rows, [F.desc_nulls_last("filing_date"), F.asc("patent_id")], size, offset)


# -- filter panel and printed report ------------------------------------------------------


def year_bounds(star: Star) -> DataFrame:
    return star.patents.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))


def country_options(star: Star) -> DataFrame:
    return star.located.select("country").distinct().orderBy("country")


def section_options(star: Star) -> DataFrame:
    rows = star.class_rows.filter(F.col("section").isNotNull())
    return rows.select("section").distinct().orderBy("section")


def class_options(star: Star, sections: Sequence[str]) -> DataFrame:
    rows = star.class_rows.filter(F.col("cpc_class").isNotNull() & F.col("section").isin(*sections))
    return rows.select("cpc_class").distinct().orderBy("cpc_class")


def printed_report(star: Star, summaries: Summaries, f: Filters) -> dict[str, DataFrame]:
    """The four tables behind the printable report."""
    by_section = (
        summaries["mv_section_yearly"]
        .filter(f.in_window())
        .groupBy("section")
        .agg(F.sum("patents").alias("patents"))
        .withColumn("section_label", section_label(F.col("section")))
        .orderBy(F.desc("patents"), "section")
    )
    places = countries(star, f) if f.by_class else countries_rollup(summaries, f)
    leaders = volumes_page(
        route_companies(star, summaries, replace(f, min_patents=0)), "company", replace(f, top_n=15)
    )
    return {
        "yearly": yearly(star, f),
        "countries": places.limit(15).withColumn("country_name", country_name(F.col("country"))),
        "sections": by_section,
        "companies": leaders.withColumn("company_short", shortened(F.col("company"))),
    }
