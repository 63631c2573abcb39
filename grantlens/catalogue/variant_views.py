"""Other forms of the standing questions."""

from __future__ import annotations

from grantlens.catalogue.filtered_views import SECTIONS, pivot_sql
from grantlens.catalogue.registry import query
from grantlens.catalogue.summary_tables import COMPANY_YEARLY, COUNTRY_YEARLY, SECTION_YEARLY
from grantlens.plans import variants


@query(
    "countries_top30",
    """
SELECT country, CAST(SUM(patents) AS BIGINT) AS patents, country AS country_name, country AS iso3
FROM mv_country_yearly WHERE country IS NOT NULL
GROUP BY country ORDER BY patents DESC, country LIMIT 30""",
    COUNTRY_YEARLY,
)
def _(t):
    return variants.countries_top(t.summaries)


@query(
    "country_share_of_patents",
    """
SELECT country, CAST(SUM(patents) AS BIGINT) AS patent_count,
       floor(CAST(SUM(patents) AS DOUBLE) / (SELECT COUNT(*) FROM patents) * 10000.0 + 0.5)
         / 10000.0 AS share
FROM mv_country_yearly GROUP BY country ORDER BY patent_count DESC, country LIMIT 5""",
    COUNTRY_YEARLY,
)
def _(t):
    return variants.country_share_of_patents(t.star, t.summaries)


@query(
    "classes_top80",
    """
SELECT section, cpc_class, COUNT(DISTINCT patent_id) AS patents,
       section || ' — ' || section AS section_label
FROM patent_cpc WHERE section IS NOT NULL AND cpc_class IS NOT NULL
GROUP BY section, cpc_class ORDER BY patents DESC, section, cpc_class LIMIT 80""",
)
def _(t):
    return variants.classes_top(t.star)


@query(
    "section_trend",
    """
SELECT year, section, CAST(SUM(patents) AS BIGINT) AS patents,
       section || ' — ' || substring(section, 1, 28) AS section_label
FROM mv_section_yearly GROUP BY year, section ORDER BY year, section""",
    SECTION_YEARLY,
)
def _(t):
    return variants.section_trend(t.summaries)


NAMES = """
inventor_names AS (
  SELECT i.name AS inventor, i.country, COUNT(DISTINCT r.patent_id) AS patents
  FROM patent_relationships r JOIN inventors i ON i.inventor_id = r.inventor_id
  WHERE i.name IS NOT NULL AND trim(i.name) <> '' GROUP BY i.name, i.country),
company_names AS (
  SELECT c.name AS company, COUNT(DISTINCT r.patent_id) AS patents
  FROM patent_relationships r JOIN companies c ON c.company_id = r.company_id
  WHERE c.name IS NOT NULL AND trim(c.name) <> '' GROUP BY c.name),
first3 AS (
  SELECT country, inventor, patents FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY country ORDER BY patents DESC, inventor) AS rn
    FROM inventor_names WHERE country IS NOT NULL) WHERE rn <= 3)"""


@query(
    "inventors_by_name",
    "SELECT * FROM inventor_names ORDER BY patents DESC, inventor, country LIMIT 20",
    NAMES,
)
def _(t):
    return variants.inventors_by_name(t.star)


@query(
    "companies_by_name",
    "SELECT * FROM company_names ORDER BY patents DESC, company LIMIT 20",
    NAMES,
)
def _(t):
    return variants.companies_by_name(t.star)


@query(
    "top3_names_by_country",
    "SELECT * FROM first3 ORDER BY country, patents DESC, inventor",
    NAMES,
)
def _(t):
    return variants.top_by_country(t.star)


@query(
    "top_countries_of_top3",
    """
SELECT * FROM first3 WHERE country IN (
  SELECT country FROM first3 GROUP BY country ORDER BY SUM(patents) DESC, country LIMIT 12)
ORDER BY country, patents DESC, inventor""",
    NAMES,
)
def _(t):
    return variants.top_by_leading_country(t.star)


@query(
    "top5_company_series",
    """
SELECT c.name AS company, p.year, COUNT(DISTINCT p.patent_id) AS patents
FROM patents p
JOIN patent_relationships r ON r.patent_id = p.patent_id
JOIN companies c ON c.company_id = r.company_id
WHERE c.name IN (SELECT company FROM company_names ORDER BY patents DESC, company LIMIT 5)
GROUP BY c.name, p.year ORDER BY p.year, company""",
    NAMES,
)
def _(t):
    return variants.company_series(t.star)


@query(
    "decade_volume",
    """
SELECT CAST(floor(year / 10.0) * 10 AS INTEGER) AS decade, COUNT(*) AS patents,
       CAST(CAST(floor(year / 10.0) * 10 AS INTEGER) AS VARCHAR) || 's' AS decade_label
FROM patents WHERE year IS NOT NULL GROUP BY 1, 3 ORDER BY 1""",
)
def _(t):
    return variants.decade_volume(t.star)


@query(
    "company_cagr_by_name",
    """
, ends AS (
  SELECT company, MIN(year) AS first_year, MAX(year) AS last_year,
         CAST(SUM(patents) AS BIGINT) AS total_patents
  FROM mv_company_yearly WHERE company IS NOT NULL GROUP BY company)
SELECT e.company, e.first_year, e.last_year, e.total_patents,
       floor((power(CAST(l.patents AS DOUBLE) / f.patents,
                    1.0 / NULLIF(e.last_year - e.first_year, 0)) - 1.0) * 10000.0 + 0.5) / 10000.0
         AS cagr
FROM ends e
JOIN mv_company_yearly f ON f.company = e.company AND f.year = e.first_year
JOIN mv_company_yearly l ON l.company = e.company AND l.year = e.last_year
WHERE e.total_patents >= 10 ORDER BY cagr DESC NULLS LAST, e.company LIMIT 15""",
    COMPANY_YEARLY,
)
def _(t):
    return variants.company_cagr_by_name(t.summaries)


SPLIT = """CAST(SUM(CASE WHEN year < 2000 THEN patents ELSE 0 END) AS BIGINT) AS before,
         CAST(SUM(CASE WHEN year >= 2000 THEN patents ELSE 0 END) AS BIGINT) AS after"""


@query(
    "country_growth_split_year",
    f"""
, split AS (SELECT country, {SPLIT} FROM mv_country_yearly GROUP BY country)
SELECT country, before, after, before + after AS total,
       floor(CAST(after - before AS DOUBLE) / NULLIF(before, 0) * 100.0 * 10000.0 + 0.5) / 10000.0
         AS growth_pct, country AS country_name
FROM split WHERE before + after >= 50 ORDER BY total DESC, country LIMIT 25""",
    COUNTRY_YEARLY,
)
def _(t):
    return variants.country_split_year(t.summaries)


@query(
    "section_growth_split_year",
    f"""
, split AS (SELECT section, {SPLIT} FROM mv_section_yearly GROUP BY section)
SELECT section, before, after,
       floor((after - before) * CAST(100.0 AS DOUBLE) / NULLIF(before, 0) * 10000.0 + 0.5) / 10000.0
         AS growth_pct
FROM split ORDER BY growth_pct DESC NULLS LAST, section""",
    SECTION_YEARLY,
)
def _(t):
    return variants.section_split_year(t.summaries)


@query(
    "section_growth_split_year_top5",
    f"""
, split AS (SELECT section, {SPLIT} FROM mv_section_yearly GROUP BY section)
SELECT section, before, after,
       floor((after - before) * CAST(1.0 AS DOUBLE) / NULLIF(before, 0) * 10000.0 + 0.5) / 10000.0
         AS growth_pct
FROM split ORDER BY growth_pct DESC NULLS LAST, section LIMIT 5""",
    SECTION_YEARLY,
)
def _(t):
    return variants.section_split_year(t.summaries, scale=1.0, limit=5)


BY_NAME = (
    NAMES
    + """,
name_matrix AS (
  SELECT company, section, COUNT(DISTINCT patent_id) AS n
  FROM (SELECT company FROM company_names ORDER BY patents DESC, company LIMIT 15)
  JOIN customer ON c_name = company JOIN company_filings ON company_id = c_custkey
  JOIN section_filings USING (patent_id) GROUP BY ALL)"""
)


@query("company_section_by_name", "SELECT * FROM name_matrix", BY_NAME)
def _(t):
    return variants.company_section_by_name(t.star)


@query("company_section_by_name_wide", pivot_sql("name_matrix", "company", "n"), BY_NAME)
def _(t):
    return variants.company_section_wide(t.star, SECTIONS)


@query(
    "decade_comparison_open",
    """
, counts AS (
  SELECT CASE WHEN p.year < 1990 THEN '1976-1989' WHEN p.year < 2000 THEN '1990-1999'
              WHEN p.year < 2010 THEN '2000-2009' WHEN p.year < 2020 THEN '2010-2019'
              ELSE '2020-2025' END AS period,
         COUNT(DISTINCT p.patent_id) AS patent_count,
         COUNT(DISTINCT r.inventor_id) AS inventor_count,
         COUNT(DISTINCT r.company_id) AS company_count
  FROM patents p LEFT JOIN patent_relationships r ON r.patent_id = p.patent_id
  WHERE p.year IS NOT NULL GROUP BY 1)
SELECT *, floor(CAST(patent_count AS DOUBLE) / (SELECT SUM(patent_count) FROM counts)
                * 10000.0 + 0.5) / 10000.0 AS share
FROM counts ORDER BY period""",
)
def _(t):
    return variants.open_periods(t.star)
