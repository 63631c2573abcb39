"""The star schema every plan works on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, functions as F

from grantlens.operators.copies import distinct_by


@dataclass(frozen=True)
class Star:
    """Five tables plus two optional facts that also carry the patent's year.

    ``dated_links`` and ``dated_cpc`` are ``links`` and ``cpc`` with the year (NULL
    where unknown). The warehouse stores them partitioned by year, so a year-window
    query prunes folders and never joins the patents table; when they are absent the
    year is joined on ``patent_id``.

    Stored links also carry the inventor's country and three flags that are true on
    exactly one row per (patent, inventor), (patent, company) and (patent, country).
    With them the distinct pairs are a filter, and patents per inventor, company or
    country are plain counts that Spark combines map-side; without them the pairs
    are made distinct. Stored classifications have such a flag per (patent, section).
    ``opened`` holds the tables as a warehouse gave them; flags are read only while they
    are still in place.

    All of these hold each combination once. Counts of distinct ids do not need that,
    so they read ``link_rows``, ``class_rows``, ``activity`` and ``classified``, in
    which a source may leave repeated rows: the count's own map-side step drops
    them, and no extra shuffle is spent on it.
    """

    patents: DataFrame
    inventors: DataFrame
    companies: DataFrame
    links: DataFrame
    cpc: DataFrame
    dated_links: DataFrame | None = None
    dated_cpc: DataFrame | None = None
    opened: Mapping[str, DataFrame] | None = None

    def as_opened(self) -> Star:
        """The same star, its tables vouched for: they come from one build."""
        tables = {f.name: getattr(self, f.name) for f in fields(Star) if f.name != "opened"}
        return Star(**tables, opened=tables)

    def _as_opened(self, *names: str) -> bool:
        """Whether these tables are still the ones the star was opened with.

        What is stored beside a table speaks of that table only: a caller who replaces a
        table gets answers from the new one, without the shortcuts of the old.
        """
        return self.opened is not None and all(
            getattr(self, name) is self.opened.get(name) for name in names
        )

    def _dated(self, table: str) -> DataFrame | None:
        """The stored fact with its year, unless the fact itself was replaced beside it."""
        dated = f"dated_{table}"
        if self.opened is None or self._as_opened(table, dated) or not self._as_opened(dated):
            return getattr(self, dated)
        return None

    @property
    def link_rows(self) -> DataFrame:
        return self.links

    @property
    def class_rows(self) -> DataFrame:
        return self.cpc

    @property
    def dated_link_rows(self) -> DataFrame:
        """(patent_id, inventor_id, company_id, year)."""
        stored = self._dated("links")
        if stored is not None:
            return stored
        return self.link_rows.join(self._years(), "patent_id", "left")

    @property
    def dated_class_rows(self) -> DataFrame:
        """(patent_id, section, cpc_class, cpc_subclass, year)."""
        stored = self._dated("cpc")
        if stored is not None:
            return stored
        return self.class_rows.join(self._years(), "patent_id", "left")

    @property
    def activity(self) -> DataFrame:
        """Link rows of patents with a known year."""
        return self.dated_link_rows.filter(F.col("year").isNotNull())

    @property
    def classified(self) -> DataFrame:
        """Classification rows with a known section and year."""
        return self.dated_class_rows.filter(
            F.col("year").isNotNull() & F.col("section").isNotNull()
        )

    def _chosen_rows(self, flag: str, columns: list[str], dated: bool) -> DataFrame | None:
        """Rows a stored flag selects, or nothing when the flag is not stored or out of date."""
        told = ["links", "dated_links"] + ["inventors"] * (flag == "one_per_country")
        if not self._as_opened(*told) or flag not in self.dated_links.columns:
            return None
        rows = self.dated_links.filter(F.col(flag))
        return _known_year(rows, dated).select(*columns, *_year(dated))

    @property
    def complete(self) -> bool:
        """Opened from a build and untouched: every link has its patent and its inventor."""
        told = ("links", "dated_links", "patents", "inventors")
        return self._as_opened(*told) and "one_per_inventor" in self.dated_links.columns

    def patents_of(self, key: str, dated: bool = False) -> DataFrame:
        """Distinct (patent_id, key[, year]); ``key`` is inventor_id or company_id."""
        flag = {"inventor_id": "one_per_inventor", "company_id": "one_per_company"}[key]
        pairs = self._chosen_rows(flag, ["patent_id", key], dated)
        if pairs is None:
            rows = self.dated_link_rows if dated else self.link_rows
            rows = _known_year(rows, dated).filter(F.col(key).isNotNull())
            return distinct_by(rows.select("patent_id", key, *_year(dated)), "patent_id")
        return pairs.filter(F.col(key).isNotNull())

    def pair_rows(self, key: str) -> DataFrame:
        """(patent_id, key, year) of patents with a known year; rows may repeat unless a flag tells them apart."""
        flag = {"inventor_id": "one_per_inventor", "company_id": "one_per_company"}[key]
        pairs = self._chosen_rows(flag, ["patent_id", key], True)
        rows = _known_year(self.dated_link_rows, True) if pairs is None else pairs
        return rows.filter(F.col(key).isNotNull()).select("patent_id", key, "year")

    def patents_in_countries(self, dated: bool = False) -> DataFrame:
        """Distinct (patent_id, country[, year]) over the known countries of a patent's inventors."""
        pairs = self._chosen_rows("one_per_country", ["patent_id", "country"], dated)
        if pairs is None:
            rows = _known_year(self.dated_link_rows if dated else self.link_rows, dated)
            rows = rows.select("patent_id", "inventor_id", *_year(dated))
            placed = rows.join(self.located, "inventor_id")
            return distinct_by(placed.select("patent_id", "country", *_year(dated)), "patent_id")
        return pairs

    def patents_in_sections(self, dated: bool = False) -> DataFrame:
        """Distinct (patent_id, section[, year]) over a patent's known sections."""
        if self._as_opened("cpc", "dated_cpc") and "one_per_section" in self.dated_cpc.columns:
            rows = _known_year(self.dated_cpc.filter(F.col("one_per_section")), dated)
            return rows.select("patent_id", "section", *_year(dated))
        rows = _known_year(self.dated_class_rows if dated else self.class_rows, dated)
        rows = rows.filter(F.col("section").isNotNull())
        return distinct_by(rows.select("patent_id", "section", *_year(dated)), "patent_id")

    @property
    def located(self) -> DataFrame:
        """(inventor_id, country) for inventors whose country is known."""
        return self.inventors.filter(country_present()).select("inventor_id", "country")

    @property
    def yearly(self) -> DataFrame:
        """(year, patents): patent_id is unique in patents, so a plain count is exact."""
        return (
            self.patents.filter(F.col("year").isNotNull())
            .groupBy("year")
            .agg(F.count(F.lit(1)).alias("patents"))
        )

    def _years(self) -> DataFrame:
        return self.patents.select("patent_id", "year")


def _year(dated: bool) -> list[str]:
    return ["year"] if dated else []


def _known_year(df: DataFrame, dated: bool) -> DataFrame:
    return df.filter(F.col("year").isNotNull()) if dated else df


def country_present():
    # `country <> ''` is NULL for a NULL country, so it drops those rows as well.
    return F.col("country").isNotNull() & (F.col("country") != "")
