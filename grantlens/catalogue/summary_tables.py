"""The summary tables."""

from __future__ import annotations

import uuid

from grantlens.catalogue.questions import (
    CAGR,
    COMPANY_YEARS,
    COUNTRY_HALVES,
    SECTION_HALVES,
    matrix_sql,
    periods_sql,
)
from grantlens.catalogue.registry import query
from grantlens.plans import summaries
from grantlens.session import shared_folder

# The decades of the comparison.
DECADE_PERIODS = [(1976, 1989), (1990, 1999), (2000, 2009), (2010, 2019), (2020, 2025)]


def _counts(view: str, columns: str, source: str, n: str = "COUNT(*)") -> str:
    return f"""
{view} AS (SELECT {columns}, {n} AS patents FROM {source} GROUP BY ALL)"""


def _totals(view: str, columns: str, source: str) -> str:
    return f"""
{view} AS (
  SELECT {columns}, COUNT(*) AS total_patents, MIN(year) AS first_year, MAX(year) AS last_year
  FROM {source} GROUP BY ALL)"""


_COMPANIES = "company_filings JOIN customer ON c_custkey = company_id"
_INVENTORS = "inventor_filings JOIN inventors USING (inventor_id)"
_PERSON = "name AS inventor, COALESCE(country, '?') AS country"

YEARLY = _counts("mv_yearly", "year", "filed")
COUNTRY_YEARLY = _counts("mv_country_yearly", "country, year", "country_filings")
SECTION_YEARLY = _counts("mv_section_yearly", "section, cpc_class, year", "class_filings")
COMPANY_TOTAL = _totals("mv_company_total", "company_id, c_name AS company", _COMPANIES)
INVENTOR_TOTAL = _totals("mv_inventor_total", f"inventor_id, {_PERSON}", _INVENTORS)
# by name: namesakes share a row, and a patent of two of them counts once
COMPANY_YEARLY = _counts(
    "mv_company_yearly", "c_name AS company, year", _COMPANIES, "COUNT(DISTINCT patent_id)"
)
INVENTOR_YEARLY = _counts(
    "mv_inventor_yearly", f"{_PERSON}, year", _INVENTORS, "COUNT(DISTINCT patent_id)"
)
DECADES = f"""
mv_decade_compare AS ({periods_sql(DECADE_PERIODS)})"""


def _plain(name: str, ctes: str, view: str | None = None) -> None:
    @query(name, f"SELECT * FROM {view or name}", ctes)
    def _(t):
        return t.summaries[name]


_plain("mv_yearly", YEARLY)
_plain("mv_country_yearly", COUNTRY_YEARLY)
_plain("mv_section_yearly", SECTION_YEARLY)
_plain("mv_company_total", COMPANY_TOTAL)
_plain("mv_inventor_total", INVENTOR_TOTAL)
_plain("mv_company_yearly", COMPANY_YEARLY)
_plain("mv_inventor_yearly", INVENTOR_YEARLY)
_plain("mv_company_section", matrix_sql(50), "matrix")
_plain("mv_decade_compare", DECADES)
_plain("mv_section_halfsplit", SECTION_HALVES, "section_halves")


@query(
    "mv_country_halfsplit",
    """
SELECT country, first_half_patents, second_half_patents,
       first_half_patents + second_half_patents AS total_patents
FROM country_halves""",
    COUNTRY_HALVES,
)
def _(t):
    return t.summaries["mv_country_halfsplit"]


@query(
    "mv_company_cagr",
    """
SELECT company_name, first_year, last_year, span_years, first_year_patents, last_year_patents,
       total_patents, cagr
FROM cagr WHERE total_patents >= 5 AND span_years >= 3 AND first_year_patents > 0""",
    COMPANY_YEARS + ", " + CAGR,
)
def _(t):
    return summaries.company_growth(t.star, min_total=5)


@query(
    "summary_audit",
    """
SELECT 'mv_yearly' AS table_name, COUNT(*) AS rows FROM mv_yearly
UNION ALL SELECT 'mv_country_yearly', COUNT(*) FROM mv_country_yearly
UNION ALL SELECT 'mv_section_yearly', COUNT(*) FROM mv_section_yearly
UNION ALL SELECT 'mv_company_total', COUNT(*) FROM mv_company_total
UNION ALL SELECT 'mv_inventor_total', COUNT(*) FROM mv_inventor_total
UNION ALL SELECT 'mv_company_yearly', COUNT(*) FROM mv_company_yearly
UNION ALL SELECT 'mv_inventor_yearly', COUNT(*) FROM mv_inventor_yearly
UNION ALL SELECT 'mv_company_section', COUNT(*) FROM matrix
UNION ALL SELECT 'mv_decade_compare', COUNT(*) FROM mv_decade_compare
UNION ALL SELECT 'mv_country_halfsplit', COUNT(*) FROM country_halves
UNION ALL SELECT 'mv_section_halfsplit', COUNT(*) FROM section_halves
UNION ALL SELECT 'mv_company_cagr', COUNT(*) FROM cagr
  WHERE total_patents >= 20 AND span_years >= 3 AND first_year_patents > 0""",
    ",".join([
        YEARLY, COUNTRY_YEARLY, SECTION_YEARLY, COMPANY_TOTAL, INVENTOR_TOTAL, COMPANY_YEARLY,
        INVENTOR_YEARLY, matrix_sql(50), DECADES, COUNTRY_HALVES,
        SECTION_HALVES, COMPANY_YEARS, CAGR,
    ]),
)
def _(t):
    folder = f"{shared_folder(t.spark)}/summaries-{uuid.uuid4().hex}"
    summaries.write_summaries(t.star, folder)
    return summaries.audit_stored(t.spark, folder)
