"""Raw tables to the clean star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantlens.functions.dates import safe_date
from grantlens.functions.text import (
    blank_to_null,
    collapsed,
    full_name,
    key_present,
    organisation_or_person,
    spaced_once,
    trimmed,
)
from grantlens.operators.counting import most_frequent, smallest_text
from grantlens.operators.ranking import first_per_key
from grantlens.star import Star


def _optional(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def clean_patents(raw: DataFrame, min_year: int, max_year: int) -> DataFrame:
    """One row per patent. The year window comes first, then the earliest date wins.

    A row without a usable date stays in (its year is unknown, not wrong). Rows are shuffled before they are sorted: a
    patent has few, so a sort of each input file would drop hardly any.
    """
    date = safe_date(F.col("patent_date"))
    parsed = raw.select(
        trimmed(F.col("patent_id")).alias("patent_id"),
        collapsed(F.col("patent_title")).alias("title"),
        spaced_once(blank_to_null(trimmed(_optional(raw, "patent_abstract")))).alias("abstract"),
        date.alias("filing_date"),
        F.year(date).alias("year"),
    )
    # min_year <= year <= max_year with the year named once: the filter is pushed below and parses the date as often as it is named
    inside = F.abs(2 * F.col("year") - (min_year + max_year)) <= max_year - min_year
    kept = parsed.filter((F.col("patent_id") != "") & F.coalesce(inside, F.lit(True)))
    order = [F.asc_nulls_last(c) for c in ("filing_date", "title", "abstract")]
    first = first_per_key(kept.repartition("patent_id"), "patent_id", order)
    return first.withColumn("title", blank_to_null(F.col("title")))


def inventor_countries(raw_inventors: DataFrame, raw_locations: DataFrame) -> DataFrame:
    """(inventor_id, country): the country an inventor is most often recorded in."""
    places = raw_locations.filter(key_present(F.col("disambig_country"))).select(
        trimmed(F.col("location_id")).alias("location_id"),
        F.upper(trimmed(F.col("disambig_country"))).alias("country"),
    )
    seen = (
        raw_inventors.filter(key_present(F.col("inventor_id")))
        .select(
            trimmed(F.col("inventor_id")).alias("inventor_id"),
            trimmed(F.col("location_id")).alias("location_id"),
        )
        # Counted before the join: a location with very many rows meets it as few rows.
        .groupBy("inventor_id", "location_id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return most_frequent(seen.join(places, "location_id"), "inventor_id", "country", "times")


def clean_inventors(
    raw: DataFrame, raw_locations: DataFrame | None = None, prefer_named: bool = False
) -> DataFrame:
    """One row per inventor: the first name in order, and the most frequent country.

    A blank name sorts first, so one blank row makes the name NULL; with
    ``prefer_named`` a blank name is used only when there is no other.
    """
    named = raw.filter(key_present(F.col("inventor_id"))).select(
        trimmed(F.col("inventor_id")).alias("inventor_id"),
        full_name(
            F.col("disambig_inventor_name_first"), F.col("disambig_inventor_name_last")
        ).alias("name"),
    )
    if prefer_named:
        named = named.withColumn("name", blank_to_null(F.col("name")))
    people = smallest_text(named, "inventor_id", "name").withColumn(
        "name", blank_to_null(F.col("name"))
    )
    if raw_locations is None:
        return people.withColumn("country", F.lit(None).cast("string"))
    return people.join(inventor_countries(raw, raw_locations), "inventor_id", "left")


def clean_companies(raw: DataFrame) -> DataFrame:
    """One row per assignee with a name; an organisation's name goes before a person's."""
    named = raw.filter(key_present(F.col("assignee_id"))).select(
        trimmed(F.col("assignee_id")).alias("company_id"),
        organisation_or_person(
            F.col("disambig_assignee_organization"),
            F.col("disambig_assignee_individual_name_first"),
            F.col("disambig_assignee_individual_name_last"),
        ).alias("name"),
    )
    return smallest_text(named.filter(F.col("name").isNotNull()), "company_id", "name")


def clean_links(
    raw_inventors: DataFrame,
    raw_assignees: DataFrame,
    patents: DataFrame,
    companies: DataFrame,
    inventors: DataFrame | None = None,
) -> DataFrame:
    """Each surviving patent's inventors, with each of its assignees.

    Copies of a pair are removed before any join. ``inventors`` is needed only when
    it was not made from the same raw rows: a table made by ``clean_inventors`` from
    ``raw_inventors`` holds every usable id, so checking against it drops nothing.
    An assignee without a company row leaves a NULL company. The patent's year comes along
    as a fourth column.
    """
    pairs = _pairs(raw_inventors).repartition("patent_id").distinct()
    if inventors is not None:
        pairs = pairs.join(inventors.select("inventor_id"), "inventor_id", "left_semi")
    owners = _owners(raw_assignees, companies).repartition("patent_id").distinct()
    return pairs.join(patents.select("patent_id", "year"), "patent_id").join(owners, "patent_id", "left").select(
        "patent_id", "inventor_id", "company_id", "year"
    )


def _pairs(raw_inventors: DataFrame) -> DataFrame:
    """(patent_id, inventor_id); rows may repeat."""
    return raw_inventors.filter(key_present(F.col("patent_id")) & key_present(F.col("inventor_id"))).select(
        trimmed(F.col("patent_id")).alias("patent_id"),
        trimmed(F.col("inventor_id")).alias("inventor_id"),
    )


def _owners(raw_assignees: DataFrame, companies: DataFrame) -> DataFrame:
    """(patent_id, company_id), NULL for an assignee without a company row; rows may repeat."""
    known = companies.select(F.col("company_id"), F.col("company_id").alias("assignee_id"))
    owners = raw_assignees.filter(key_present(F.col("patent_id")) & key_present(F.col("assignee_id"))).select(
        trimmed(F.col("patent_id")).alias("patent_id"),
        trimmed(F.col("assignee_id")).alias("assignee_id"),
    )
    return owners.join(known, "assignee_id", "left").select("patent_id", "company_id")


def _numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Distinct rows by patent, with a flag on the first one of each group of ``keys`` (the patent and columns after it).

    The keys and ``order`` are all columns. One shuffle by patent and one sort, which may spill, serve the copies, the flag
    and joins by patent that follow; a hash table would hold every row of a task, twice.
    """
    group = Window.partitionBy(*keys).orderBy(*(F.asc_nulls_last(c) for c in order))
    copy = reduce(Column.__and__, (F.col(c).eqNullSafe(F.lag(c).over(group)) for c in order))
    seen = rows.repartition("patent_id").withColumn(name, F.row_number().over(group) == 1).withColumn("_copy", copy)
    return seen.filter(F.col(name) | ~F.col("_copy")).drop("_copy")


def marked_links(
    raw_inventors: DataFrame, raw_assignees: DataFrame, patents: DataFrame, companies: DataFrame, inventors: DataFrame
) -> DataFrame:
    """What ``mark_links`` makes of ``clean_links``, from one shuffle of each raw table by patent.

    A patent's links are all its inventors with all its companies, so inventors and companies are
    chosen before the two meet: on fewer rows, and without joining the choices back.
    """
    located = _pairs(raw_inventors).join(inventors.select("inventor_id", "country"), "inventor_id", "left")
    known = F.col("country").isNotNull() & (F.col("country") != "")
    whole = Window.partitionBy("patent_id")
    people = _numbered(located, ["patent_id", "country"], ["inventor_id"], "_local").withColumn(
        "_inventor", F.col("inventor_id") == F.min("inventor_id").over(whole)
    )
    owners = _numbered(_owners(raw_assignees, companies), ["patent_id"], ["company_id"], "_company")
    first_company = F.coalesce("_company", F.lit(True))  # a patent without an owner has one link per inventor
    return people.join(patents.select("patent_id", "year"), "patent_id").join(owners, "patent_id", "left").select(
        "patent_id",
        "inventor_id",
        "company_id",
        "year",
        "country",
        first_company.alias("one_per_inventor"),
        F.col("_inventor").alias("one_per_company"),
        (first_company & F.col("_local") & known).alias("one_per_country"),
    )


def mark_links(links: DataFrame, inventors: DataFrame) -> DataFrame:
    """Add the inventor's country and the flags ``Star`` describes to (…, year) links.

    A patent's links are all its inventors with all its companies. So the rows of
    one chosen company hold each inventor once, the rows of one chosen inventor
    hold each company once, and an inventor chosen per country, with the chosen
    company, holds each country once. Choices are smallest ids, found by
    aggregates that shrink map-side; no window gathers a patent's rows.
    """
    known = F.col("country").isNotNull() & (F.col("country") != "")
    located = links.join(inventors.select("inventor_id", "country"), "inventor_id", "left")
    chosen = links.groupBy("patent_id").agg(
        F.min("company_id").alias("_company"), F.min("inventor_id").alias("_inventor")
    )
    per_country = (
        located.filter(known)
        .groupBy("patent_id", "country")
        .agg(F.min("inventor_id").alias("_local"))
    )
    first_company = F.col("company_id").eqNullSafe(F.col("_company"))
    return (
        located.join(per_country, ["patent_id", "country"], "left")
        .join(chosen, "patent_id")
        .select(
            "patent_id",
            "inventor_id",
            "company_id",
            "year",
            "country",
            first_company.alias("one_per_inventor"),
            (F.col("inventor_id") == F.col("_inventor")).alias("one_per_company"),
            (first_company & F.col("inventor_id").eqNullSafe(F.col("_local"))).alias(
                "one_per_country"
            ),
        )
    )


def _codes(raw: DataFrame) -> DataFrame:
    """Classifications; rows may repeat. A blank section becomes NULL."""
    return raw.filter(key_present(F.col("patent_id")) & F.col("cpc_section").isNotNull()).select(
        trimmed(F.col("patent_id")).alias("patent_id"),
        blank_to_null(trimmed(F.col("cpc_section"))).alias("section"),
        blank_to_null(trimmed(F.col("cpc_class"))).alias("cpc_class"),
        blank_to_null(trimmed(F.col("cpc_subclass"))).alias("cpc_subclass"),
    )


def clean_cpc(raw: DataFrame, patents: DataFrame) -> DataFrame:
    """Distinct classifications of surviving patents, with their year; a blank section becomes NULL."""
    # shuffled on the patent alone, which serves the join too
    return _codes(raw).repartition("patent_id").distinct().join(patents.select("patent_id", "year"), "patent_id")


def marked_cpc(raw: DataFrame, patents: DataFrame) -> DataFrame:
    """Distinct classifications as ``clean_cpc`` makes them, with a flag on one row per (patent, section)."""
    codes = _numbered(_codes(raw), ["patent_id", "section"], ["cpc_class", "cpc_subclass"], "_first")
    return codes.join(patents.select("patent_id", "year"), "patent_id").withColumn(
        "one_per_section", F.col("_first") & F.col("section").isNotNull()
    ).drop("_first")


def mark_cpc(classes: DataFrame) -> DataFrame:
    """Add a flag that is true on one row per (patent, section): the first class and subclass."""
    per_section = Window.partitionBy("patent_id", "section").orderBy("cpc_class", "cpc_subclass")
    first = F.row_number().over(per_section) == 1
    return classes.withColumn("one_per_section", first & F.col("section").isNotNull())


def clean_star(
    raw: Mapping[str, DataFrame],
    min_year: int = 1976,
    max_year: int = 2025,
    prefer_named: bool = False,
) -> Star:
    """All five clean tables from the raw ones (see ``sources.delimited.read_raw``)."""
    patents = clean_patents(raw["patents"], min_year, max_year)
    inventors = clean_inventors(raw["inventors"], raw["locations"], prefer_named)
    companies = clean_companies(raw["assignees"])
    links = clean_links(raw["inventors"], raw["assignees"], patents, companies)
    return _assemble(patents, inventors, companies, links, clean_cpc(raw["cpc"], patents))


def _assemble(patents, inventors, companies, dated_links, dated_cpc) -> Star:
    return Star(
        patents=patents,
        inventors=inventors,
        companies=companies,
        links=dated_links.drop("year"),
        cpc=dated_cpc.drop("year"),
        dated_links=dated_links,
        dated_cpc=dated_cpc,
    )
