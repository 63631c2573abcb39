"""Data-quality report of a star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.operators.quality import orphans, report
from grantlens.star import Star, country_present

KEYS = {"patents": "patent_id", "inventors": "inventor_id", "companies": "company_id"}


def _mentions(star: Star, min_year: int, max_year: int) -> DataFrame:
    """(table, id, defined, links, classes, late): each entity row, and each id that a link or class refers to."""
    late = F.col("year").isNotNull() & ~F.col("year").between(min_year, max_year)

    def counted(df: DataFrame, table: str | Column, key: str | Column, **what: Column) -> DataFrame:
        table = F.lit(table) if isinstance(table, str) else table
        zero = F.lit(0).cast("long")
        return df.select(table.alias("table"), F.col(key).cast("string").alias("id") if isinstance(key, str) else key.alias("id"), *(
            what.get(c, zero).cast("long").alias(c) for c in ("defined", "links", "classes", "late")))

    one = F.lit(1)
    parts = [counted(star.patents, "patents", "patent_id", defined=one, late=F.when(late, 1).otherwise(0))]
    parts += [counted(getattr(star, t), t, KEYS[t], defined=one) for t in ("inventors", "companies")]
    named = star.links.select(F.explode(F.array(*(
        F.struct(F.lit(t).alias("table"), F.col(k).cast("string").alias("id")) for t, k in KEYS.items()))).alias("of"))
    parts.append(counted(named, F.col("of.table"), F.col("of.id"), links=one))
    parts.append(counted(star.cpc, "patents", "patent_id", classes=one))
    return reduce(DataFrame.unionByName, parts)


def quality_report(
    star: Star,
    min_year: int,
    max_year: int,
    min_country_share: float = 0.5,
    min_countries: int = 3,
) -> DataFrame:
    """(table_name, check_name, failures); zero everywhere means the star is sound.

    Each table is read once: entity rows and references are added up per id, and all rules about keys, references,
    missing ids and sizes are read off these sums. Only the countries of inventors take a second look at them.
    """
    sums = _mentions(star, min_year, max_year).groupBy("table", "id").agg(
        *(F.sum(c).alias(c) for c in ("defined", "links", "classes", "late")))
    missing, unknown = F.col("id").isNull(), F.col("id").isNotNull() & (F.col("defined") == 0)

    def of(table: str, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("table") == table, count)), F.lit(0))

    def empty(total: Column) -> Column:
        return F.when(total == 0, 1).otherwise(0)

    rules = {(t, "duplicate_key"): of(t, (F.col("defined") > 1).cast("long")) for t in KEYS}
    rules |= {
        ("links", "patent_id_null"): of("patents", F.when(missing, F.col("links"))),
        ("links", "inventor_id_null"): of("inventors", F.when(missing, F.col("links"))),
        ("cpc", "patent_id_null"): of("patents", F.when(missing, F.col("classes"))),
        ("links", "patent_unknown"): of("patents", F.when(unknown, F.col("links"))),
        ("links", "inventor_unknown"): of("inventors", F.when(unknown, F.col("links"))),
        ("links", "company_unknown"): of("companies", F.when(unknown, F.col("links"))),
        ("cpc", "patent_unknown"): of("patents", F.when(unknown, F.col("classes"))),
        ("patents", "year_out_of_range"): of("patents", F.col("late")),
    }
    rules |= {(t, "empty"): empty(of(t, F.col("defined"))) for t in KEYS}
    rules["links", "empty"] = empty(of("patents", F.col("links")))
    filled = F.avg(F.when(country_present(), 1.0).otherwise(0.0))
    known = F.count_distinct(F.when(country_present(), F.col("country")))
    countries = {
        ("inventors", "country_fill"): (F.coalesce(filled, F.lit(0.0)) <= min_country_share).cast("long"),
        ("inventors", "country_variety"): (known < min_countries).cast("long"),
    }
    return report([_told(sums, rules), _told(star.inventors, countries)])


def _told(df: DataFrame, rules: dict[tuple[str, str], Column]) -> DataFrame:
    """One row per rule, from one aggregate over ``df``."""
    counts = df.agg(*(c.cast("long").alias(f"_{k}") for k, c in enumerate(rules.values())))
    rows = F.array(*(
        F.struct(F.lit(t).alias("table_name"), F.lit(name).alias("check_name"), F.col(f"_{k}").alias("failures"))
        for k, (t, name) in enumerate(rules)))
    return counts.select(F.explode(rows).alias("rule")).select("rule.*")


def orphan_counts(star: Star) -> DataFrame:
    """(reference, n): link and class rows that point to nothing."""
    rows = {
        "links.patent_id": orphans(star.links, star.patents, "patent_id"),
        "links.inventor_id": orphans(star.links, star.inventors, "inventor_id"),
        "links.company_id": orphans(star.links, star.companies, "company_id"),
        "cpc.patent_id": orphans(star.cpc, star.patents, "patent_id"),
    }
    return report([
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reference"), "n")
        for name, df in rows.items()
    ])
