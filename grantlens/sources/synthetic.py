"""Generated raw tables with the layout and the typical dirt of the real files.

Every value is a function of the row's id and a salt, so any number of
partitions and any retry gives the same rows, and the tables are made in
parallel without state. ``keys`` is a DataFrame with one whole-number column.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantlens.functions.draws import below, pick, triangular, uniform

# Draw weights.
COUNTRY_WEIGHTS = [
    ("US", 0.48), ("CN", 0.18), ("JP", 0.09), ("KR", 0.06), ("DE", 0.05), ("GB", 0.03),
    ("FR", 0.02), ("CA", 0.02), ("IN", 0.02), ("TW", 0.02), ("NL", 0.01), ("CH", 0.01),
    ("SE", 0.01),
]
INVENTORS_PER_PATENT = [(1, 0.30), (2, 0.35), (3, 0.20), (4, 0.10), (5, 0.05)]
ASSIGNEES_PER_PATENT = [(0, 0.05), (1, 0.85), (2, 0.10)]
CLASSES_PER_PATENT = [(1, 0.50), (2, 0.35), (3, 0.15)]
SECTIONS = "ABCDEFGHY"
SUBCLASSES = "ABCDKN"
MODE_OF_DATES = 0.65
BASE_PATENTS = 5_000
FIRST_PATENT = 11_000_000


def numbered(spark: SparkSession, scale: float = 1.0) -> DataFrame:
    return spark.range(FIRST_PATENT, FIRST_PATENT + int(BASE_PATENTS * scale)).toDF("key")


def _key(keys: DataFrame) -> Column:
    return F.col(keys.columns[0])


def patent_rows(keys: DataFrame, start: date, end: date) -> DataFrame:
    """(patent_id, patent_date, patent_title, patent_abstract); dates lean to later years."""
    key = _key(keys)
    days = (end - start).days
    offset = F.floor(triangular(uniform(key, "date"), 0.0, days * MODE_OF_DATES, float(days)))
    day = F.date_add(F.lit(start), offset.cast("int"))
    blank = F.lit("")
    # Dirt: about one row in two hundred has no date, no abstract or an untidy title.
    dirt = uniform(key, "dirt")
    return keys.select(
        key.cast("string").alias("patent_id"),
        F.when(dirt < 0.005, blank).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("patent_date"),
        F.when(
            (dirt >= 0.005) & (dirt < 0.010),
            F.concat(F.lit("   Trimmed    method "), key.cast("string"), F.lit("   ")),
        )
        .otherwise(F.concat(F.lit("Method "), key.cast("string")))
        .alias("patent_title"),
        F.when((dirt >= 0.010) & (dirt < 0.015), blank)
        .otherwise(F.concat(F.lit("Apparatus for method "), key.cast("string"), F.lit(".")))
        .alias("patent_abstract"),
    )


def _repeated(keys: DataFrame, weights, salt: str, name: str) -> DataFrame:
    """One row per (key, 1..n), n drawn from ``weights``."""
    key = _key(keys)
    n = pick(uniform(key, salt), weights)
    steps = F.filter(F.sequence(F.lit(1), F.lit(weights[-1][0])), lambda i: i <= n)
    return keys.select(key.alias("_key"), F.explode(steps).alias(name))


def _draw(salt: str, step: str) -> Column:
    return uniform(F.concat_ws("/", F.col("_key").cast("string"), F.col(step).cast("string")), salt)


def inventor_rows(keys: DataFrame, inventors: int, locations: int) -> DataFrame:
    rows = _repeated(keys, INVENTORS_PER_PATENT, "inventors", "inventor_sequence")
    person = below(_draw("person", "inventor_sequence"), inventors)
    place = below(_draw("place", "inventor_sequence"), locations)
    missing = _draw("dirt", "inventor_sequence") < 0.002
    return rows.select(
        F.col("_key").cast("string").alias("patent_id"),
        "inventor_sequence",
        F.when(missing, F.lit("")).otherwise(
            F.concat(F.lit("inv-"), person.cast("string"))
        ).alias("inventor_id"),
        F.concat(F.lit("First"), person.cast("string")).alias("disambig_inventor_name_first"),
        F.concat(F.lit("Last"), person.cast("string")).alias("disambig_inventor_name_last"),
        F.concat(F.lit("loc-"), place.cast("string")).alias("location_id"),
    )


def assignee_rows(keys: DataFrame, companies: int) -> DataFrame:
    rows = _repeated(keys, ASSIGNEES_PER_PATENT, "assignees", "assignee_sequence")
    company = below(_draw("company", "assignee_sequence"), companies).cast("string")
    return rows.select(
        F.col("_key").cast("string").alias("patent_id"),
        "assignee_sequence",
        F.concat(F.lit("org-"), company).alias("assignee_id"),
        F.lit(None).cast("string").alias("disambig_assignee_individual_name_first"),
        F.lit(None).cast("string").alias("disambig_assignee_individual_name_last"),
        F.concat(F.lit("Company "), company).alias("disambig_assignee_organization"),
    )


def class_rows(keys: DataFrame) -> DataFrame:
    rows = _repeated(keys, CLASSES_PER_PATENT, "classes", "cpc_sequence")
    section = F.substring(
        F.lit(SECTIONS), below(_draw("section", "cpc_sequence"), len(SECTIONS)) + 1, F.lit(1)
    )
    number = F.lpad((below(_draw("class", "cpc_sequence"), 20) + 1).cast("string"), 2, "0")
    letter = F.substring(
        F.lit(SUBCLASSES), below(_draw("subclass", "cpc_sequence"), len(SUBCLASSES)) + 1, F.lit(1)
    )
    return rows.select(
        F.col("_key").cast("string").alias("patent_id"),
        "cpc_sequence",
        section.alias("cpc_section"),
        F.concat(section, number).alias("cpc_class"),
        F.concat(section, number, letter).alias("cpc_subclass"),
    )


def location_rows(numbers: DataFrame) -> DataFrame:
    """One location per number, its country drawn from the weights."""
    key = _key(numbers)
    return numbers.select(
        F.concat(F.lit("loc-"), key.cast("string")).alias("location_id"),
        pick(uniform(key, "country"), COUNTRY_WEIGHTS).alias("disambig_country"),
    )


def raw_tables(
    spark: SparkSession,
    scale: float = 1.0,
    start: date = date(2010, 1, 1),
    end: date = date(2025, 9, 30),
) -> dict[str, DataFrame]:
    """The five raw tables of a made-up corpus."""
    keys = numbered(spark, scale)
    locations = max(int(600 * scale), 600)
    return {
        "patents": patent_rows(keys, start, end),
        "inventors": inventor_rows(keys, max(int(6_000 * scale), 6_000), locations),
        "assignees": assignee_rows(keys, 60),
        "locations": location_rows(spark.range(locations).toDF("key")),
        "cpc": class_rows(keys),
    }
