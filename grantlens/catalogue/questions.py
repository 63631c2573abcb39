"""The standing questions."""

from __future__ import annotations

from grantlens.catalogue.registry import query
from grantlens.plans import analysis

# Periods that fit the role data's years.
PERIODS = [(1995, 1996), (1997, 1998), (1999, 2001)]


@query(
    "top_inventors",
    """
SELECT inventor_id, name AS inventor_name, country, COUNT(*) AS patent_count
FROM inventor_filings JOIN inventors USING (inventor_id) GROUP BY ALL
ORDER BY patent_count DESC, inventor_name, inventor_id LIMIT 20""",
)
def _(t):
    return analysis.top_inventors(t.star)


@query(
    "top_companies",
    """
SELECT company_id, c_name AS company_name, COUNT(*) AS patent_count
FROM company_filings JOIN customer ON c_custkey = company_id GROUP BY ALL
ORDER BY patent_count DESC, company_name, company_id LIMIT 20""",
)
def _(t):
    return analysis.top_companies(t.star)


@query(
    "country_share",
    """
SELECT country, COUNT(*) AS patent_count,
       floor(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 10000.0 + 0.5) / 10000.0 AS share
FROM country_filings GROUP BY country ORDER BY patent_count DESC, country LIMIT 15""",
)
def _(t):
    return analysis.country_share(t.star)


@query(
    "yearly_trend",
    """
SELECT year, COUNT(*) AS patent_count FROM filed GROUP BY year ORDER BY year""",
)
def _(t):
    return analysis.yearly_trend(t.star)


@query(
    "wide_join",
    """
SELECT o_orderkey AS patent_id, o_orderpriority AS patent_title, CAST(o_orderdate AS DATE) AS filing_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, s_name AS inventor_name, n_name AS inventor_country,
       c_name AS company_name
FROM orders JOIN inventor_filings ON patent_id = o_orderkey
JOIN supplier ON s_suppkey = inventor_id JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus <> 'P'
ORDER BY o_orderdate IS NULL, 4 DESC, o_orderkey, s_name, s_suppkey, c_custkey NULLS LAST LIMIT 500""",
)
def _(t):
    return analysis.wide_join(t.star)


COMPANY_YEARS = """
company_years AS (
  SELECT company_id, c_name AS company_name, year, COUNT(*) AS n
  FROM company_filings JOIN customer ON c_custkey = company_id GROUP BY ALL)"""


@query(
    "innovation_leaders",
    """
SELECT company_name, year, n AS patents_filed, earlier AS prev_year_patents,
       n - COALESCE(earlier, 0) AS yoy_delta,
       floor(CAST(n - earlier AS DOUBLE) / NULLIF(earlier, 0) * 10000.0 + 0.5) / 10000.0 AS yoy_growth_pct
FROM (SELECT *, arg_max(n, year) OVER (PARTITION BY company_id ORDER BY year
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM company_years)
WHERE n >= 2 AND year = (
  SELECT MAX(year) FROM (SELECT year, COUNT(*) AS volume FROM filed GROUP BY year
                         QUALIFY volume >= 0.6 * MAX(volume) OVER ()))
ORDER BY yoy_growth_pct DESC NULLS LAST, patents_filed DESC, company_id LIMIT 20""",
    COMPANY_YEARS,
)
def _(t):
    return analysis.innovation_leaders(t.star)


@query(
    "top3_inventors_by_country",
    """
SELECT country, CAST(RANK() OVER (PARTITION BY country ORDER BY patent_count DESC) AS INTEGER) AS country_rank,
       inventor_name, patent_count
FROM (SELECT country, inventor_id, name AS inventor_name, COUNT(*) AS patent_count
      FROM inventor_filings JOIN inventors USING (inventor_id) GROUP BY ALL)
QUALIFY ROW_NUMBER() OVER (PARTITION BY country ORDER BY patent_count DESC, inventor_name, inventor_id) <= 3
ORDER BY country, country_rank, inventor_name""",
)
def _(t):
    return analysis.top_inventors_by_country(t.star)


def periods_sql(periods: list[tuple[int, int]]) -> str:
    """Counts of patents, inventors and companies per period, as SQL over a table of the periods."""
    rows = ", ".join(f"('{first}-{last}', {first}, {last})" for first, last in periods)

    def seen(column: str, filings: str) -> str:
        return f"(SELECT COUNT(DISTINCT {column}) FROM {filings} WHERE year BETWEEN low AND high)"

    return f"""
SELECT *, floor(CAST(patent_count AS DOUBLE) / SUM(patent_count) OVER () * 10000.0 + 0.5) / 10000.0 AS share
FROM (SELECT period, {seen('patent_id', 'filed')} AS patent_count,
             {seen('inventor_id', 'inventor_filings')} AS inventor_count,
             {seen('company_id', 'company_filings')} AS company_count
      FROM (VALUES {rows}) periods(period, low, high))
WHERE patent_count > 0"""


@query("period_comparison", periods_sql(PERIODS) + " ORDER BY period")
def _(t):
    return analysis.period_comparison(t.star, PERIODS)


CAGR = """
cagr AS (
  SELECT company_id, company_name, MIN(year) AS first_year, MAX(year) AS last_year,
         MAX(year) - MIN(year) AS span_years, arg_min(n, year) AS first_year_patents,
         arg_max(n, year) AS last_year_patents, CAST(SUM(n) AS BIGINT) AS total_patents,
         floor((power(CAST(arg_max(n, year) AS DOUBLE) / CAST(arg_min(n, year) AS DOUBLE),
                      1.0 / NULLIF(MAX(year) - MIN(year), 0)) - 1.0) * 10000.0 + 0.5) / 10000.0 AS cagr
  FROM company_years GROUP BY company_id, company_name)"""


@query(
    "company_cagr",
    """
SELECT company_name, first_year, last_year, span_years, first_year_patents, last_year_patents,
       total_patents, cagr
FROM cagr WHERE total_patents >= 5 AND span_years >= 3 AND first_year_patents > 0
ORDER BY cagr DESC NULLS LAST, total_patents DESC, company_id LIMIT 25""",
    COMPANY_YEARS + ", " + CAGR,
)
def _(t):
    return analysis.company_cagr(t.star, min_total=5)


def halves_sql(key: str) -> str:
    return f"""
{key}_halves AS (
  SELECT {key}, COUNT(*) FILTER (2 * year <= span) AS first_half_patents,
         COUNT(*) FILTER (2 * year > span) AS second_half_patents
  FROM {key}_filings, (SELECT MIN(year) + MAX(year) AS span FROM filed) GROUP BY {key})"""


COUNTRY_HALVES, SECTION_HALVES = halves_sql("country"), halves_sql("section")

GROWTH = """first_half_patents, second_half_patents,
       second_half_patents - first_half_patents AS delta,
       floor(CAST(second_half_patents - first_half_patents AS DOUBLE)
             / NULLIF(first_half_patents, 0) * 10000.0 + 0.5) / 10000.0 AS growth_pct,
       first_half_patents + second_half_patents AS total_patents"""


@query(
    "country_growth_halves",
    f"""
SELECT country, {GROWTH} FROM country_halves
WHERE first_half_patents + second_half_patents >= 30
ORDER BY growth_pct DESC NULLS LAST, total_patents DESC, country LIMIT 25""",
    COUNTRY_HALVES,
)
def _(t):
    return analysis.country_growth(t.star)


@query(
    "section_growth_halves",
    f"""
SELECT section, {GROWTH} FROM section_halves
ORDER BY growth_pct DESC NULLS LAST, total_patents DESC, section""",
    SECTION_HALVES,
)
def _(t):
    return analysis.section_growth(t.star)


def matrix_sql(limit: int) -> str:
    return f"""
matrix AS (
  SELECT company_name, section, COUNT(DISTINCT patent_id) AS patents
  FROM (SELECT company_id, c_name AS company_name
        FROM company_filings JOIN customer ON c_custkey = company_id GROUP BY ALL
        ORDER BY COUNT(*) DESC, c_name, company_id LIMIT {limit})
  JOIN company_filings USING (company_id) JOIN section_filings USING (patent_id) GROUP BY ALL)"""


@query("company_section_matrix", "SELECT * FROM matrix ORDER BY 1, 2", matrix_sql(15))
def _(t):
    return analysis.company_section_matrix(t.star)


@query(
    "totals",
    """
SELECT (SELECT COUNT(*) FROM patents) AS total_patents,
       (SELECT COUNT(*) FROM inventors) AS total_inventors,
       (SELECT COUNT(*) FROM companies) AS total_companies,
       (SELECT COUNT(*) FROM patent_relationships) AS total_relationships,
       (SELECT MIN(year) FROM patents) AS year_min, (SELECT MAX(year) FROM patents) AS year_max""",
)
def _(t):
    return analysis.totals(t.star)


@query(
    "section_breakdown",
    """
SELECT section, COUNT(*) AS patent_count, section AS section_label
FROM section_filings GROUP BY section ORDER BY patent_count DESC, section""",
)
def _(t):
    return analysis.section_breakdown(t.star)


@query(
    "sql_text_with_parameters",
    """
SELECT year, COUNT(DISTINCT patent_id) AS patents
FROM patents JOIN patent_relationships USING (patent_id)
WHERE year >= 1997 GROUP BY year ORDER BY year""",
)
def _(t):
    return analysis.run_sql(
        t.star,
        """
        SELECT year, COUNT(DISTINCT patent_id) AS patents
        FROM {patents} JOIN {patent_relationships} USING (patent_id)
        WHERE year >= :first GROUP BY year ORDER BY year
        """,
        {"first": 1997},
    )
