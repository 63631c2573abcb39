"""Report files and display columns, made from the standing answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from grantlens.functions.numbers import percent_text
from grantlens.operators.reshaping import slim
from grantlens.sources.delimited import write_csv

# Report name -> (answer, row cap).
CSV_REPORTS = {
    "top_inventors": ("top_inventors", 20),
    "top_companies": ("top_companies", 20),
    "country_trends": ("country_share", 15),
    "yearly_trends": ("yearly_trend", None),
    "cpc_breakdown": ("section_breakdown", None),
    "decade_comparison": ("period_comparison", None),
    "company_cagr": ("company_cagr", None),
    "country_growth_rates": ("country_growth", None),
    "section_growth": ("section_growth", None),
    "company_section_matrix": ("company_section_matrix", None),
}

# JSON field -> (answer, {column: name in the report}, record cap).
JSON_RECORDS = {
    "top_inventors": (
        "top_inventors",
        {"inventor_name": "name", "country": "country", "patent_count": "patents"},
        20,
    ),
    "top_companies": (
        "top_companies", {"company_name": "name", "patent_count": "patents"}, 20,
    ),
    "top_countries": (
        "country_share", {"country": "country", "patent_count": "patents", "share": "share"}, 15,
    ),
    "yearly_trends": ("yearly_trend", {"year": "year", "patent_count": "patents"}, None),
    "top_ranked_inventors_by_country": (
        "top_inventors_by_country",
        {
            "country": "country", "inventor_name": "name", "country_rank": "rank",
            "patent_count": "patents",
        },
        None,
    ),
    "cpc_breakdown": (
        "section_breakdown",
        {"section": "section", "section_label": "label", "patent_count": "patents"},
        None,
    ),
}
JSON_ADVANCED = {
    "decade_comparison": ("period_comparison", None, None),
    "company_cagr": (
        "company_cagr",
        {
            "company_name": "name", "first_year": "first_year", "last_year": "last_year",
            "span_years": "span_years", "first_year_patents": "first_year_patents",
            "last_year_patents": "last_year_patents", "total_patents": "total_patents",
            "cagr": "cagr",
        },
        15,
    ),
    "country_growth_rates": ("country_growth", None, None),
    "section_growth": ("section_growth", None, None),
    "company_section_matrix": ("company_section_matrix", None, None),
}

# How each answer's records are ordered inside the report.
ORDERS = {
    "top_inventors": ["-patent_count", "inventor_name", "inventor_id"],
    "top_companies": ["-patent_count", "company_name", "company_id"],
    "country_share": ["-patent_count", "country"],
    "yearly_trend": ["year"],
    "top_inventors_by_country": ["country", "country_rank", "inventor_name"],
    "section_breakdown": ["-patent_count", "section"],
    "period_comparison": ["period"],
    "company_cagr": ["-cagr", "-total_patents", "company_name"],
    "country_growth": ["-growth_pct", "-total_patents", "country"],
    "section_growth": ["-growth_pct", "-total_patents", "section"],
    "company_section_matrix": ["company_name", "section"],
}


def _ordering(answer: str) -> list[Column]:
    return [
        F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c)
        for c in ORDERS[answer]
    ]


def head(df: DataFrame, answer: str, limit: int | None) -> DataFrame:
    ordered = df.orderBy(*_ordering(answer))
    return ordered if limit is None else ordered.limit(limit)


def write_csv_reports(answers: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder per report, capped as configured; result-sized, hence one file each."""
    paths = {}
    for report, (answer, cap) in CSV_REPORTS.items():
        paths[report] = f"{folder}/{report}"
        write_csv(head(answers[answer], answer, cap), paths[report], files=1)
    return paths


def _records(df: DataFrame, answer: str, columns: dict | None, limit: int | None) -> Column:
    """The answer as one ordered array of structs (scalar subquery)."""
    position = F.row_number().over(Window.orderBy(*_ordering(answer)))
    numbered = df.withColumn("_position", position)
    if limit is not None:
        numbered = numbered.filter(F.col("_position") <= limit)
    names = columns or {c: c for c in df.columns}
    record = F.struct(*[F.col(old).alias(new) for old, new in names.items()])
    pairs = F.sort_array(F.collect_list(F.struct(F.col("_position"), record.alias("record"))))
    return numbered.agg(F.transform(pairs, lambda p: p["record"]).alias("records")).scalar()


def json_report(answers: dict[str, DataFrame]) -> DataFrame:
    """One row holding the whole nested report. Every part is result-sized."""
    totals = answers["totals"]
    parts = {
        field: _records(answers[answer], answer, columns, limit)
        for field, (answer, columns, limit) in JSON_RECORDS.items()
    }
    advanced = [
        _records(answers[answer], answer, columns, limit).alias(field)
        for field, (answer, columns, limit) in JSON_ADVANCED.items()
    ]
    return totals.select(
        "total_patents",
        "total_inventors",
        "total_companies",
        "total_relationships",
        F.struct(F.col("year_min").alias("min"), F.col("year_max").alias("max")).alias("year_range"),
        *[column.alias(field) for field, column in parts.items()],
        F.struct(*advanced).alias("advanced_analytics"),
    )


def write_json_report(answers: dict[str, DataFrame], folder: str) -> None:
    json_report(answers).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(folder)


def read_json_report(spark: SparkSession, path: str, field: str) -> DataFrame:
    """One list of a stored report as numbered rows."""
    document = spark.read.option("multiLine", "true").json(path)
    rows = document.select(F.posexplode(field).alias("position", "record"))
    return rows.select((F.col("position") + 1).alias("position"), "record.*")


def with_percent(df: DataFrame, column: str, name: str, digits: int = 1) -> DataFrame:
    return df.withColumn(name, percent_text(F.col(column), digits))


def one_line(df: DataFrame, order: Sequence[Column], text: Column, limit: int = 5) -> DataFrame:
    """'1. First - 10 2. Second - 9 ...' for the first rows, as one row."""
    position = F.row_number().over(Window.orderBy(*order))
    first = df.orderBy(*order).limit(limit).withColumn("_position", position)
    entry = F.concat(F.col("_position").cast("string"), F.lit(". "), text)
    entries = F.sort_array(F.collect_list(F.struct(F.col("_position").alias("p"), entry.alias("e"))))
    return first.agg(F.concat_ws(" ", F.transform(entries, lambda x: x["e"])).alias("line"))


def summary_lines(answers: dict[str, DataFrame], limit: int = 5) -> DataFrame:
    """(title, line): the console report's one-line leaderboards."""
    def grouped(c):
        return F.format_number(F.col(c), 0)

    lines = {
        "Top Inventors": (
            "top_inventors",
            F.concat("inventor_name", F.lit(" - "), F.col("patent_count").cast("string")),
        ),
        "Top Companies": (
            "top_companies", F.concat("company_name", F.lit(" - "), grouped("patent_count")),
        ),
        "Top Countries": ("country_share", F.col("country")),
    }
    rows = None
    for title, (answer, text) in lines.items():
        line = one_line(answers[answer], _ordering(answer), text, limit).select(
            F.lit(title).alias("title"), "line"
        )
        rows = line if rows is None else rows.unionByName(line)
    return rows


def slim_records(answers: dict[str, DataFrame], field: str) -> DataFrame:
    """The renamed rows of one JSON list, before they are nested."""
    answer, columns, limit = {**JSON_RECORDS, **JSON_ADVANCED}[field]
    rows = head(answers[answer], answer, limit)
    return slim(rows, columns) if columns else rows
