"""Fixed schemas: raw files (all text) and the five clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Column layout of the raw files.
RAW = {
    "patents": _text(
        "patent_id", "patent_type", "patent_date", "patent_title", "patent_abstract",
        "wipo_kind", "num_claims", "withdrawn", "filename",
    ),
    "inventors": _text(
        "patent_id", "inventor_sequence", "inventor_id", "disambig_inventor_name_first",
        "disambig_inventor_name_last", "gender_code", "location_id",
    ),
    "assignees": _text(
        "patent_id", "assignee_sequence", "assignee_id",
        "disambig_assignee_individual_name_first", "disambig_assignee_individual_name_last",
        "disambig_assignee_organization", "assignee_type", "location_id",
    ),
    "locations": _text(
        "location_id", "disambig_city", "disambig_state", "disambig_country", "latitude",
        "longitude", "county", "state_fips", "county_fips",
    ),
    "cpc": _text(
        "patent_id", "cpc_sequence", "cpc_section", "cpc_class", "cpc_subclass", "cpc_group",
        "cpc_type",
    ),
}

# Raw file names.
RAW_FILES = {
    "patents": "g_patent.tsv",
    "inventors": "g_inventor_disambiguated.tsv",
    "assignees": "g_assignee_disambiguated.tsv",
    "locations": "g_location_disambiguated.tsv",
    "cpc": "g_cpc_current.tsv",
}

CLEAN = {
    "patents": StructType([
        StructField("patent_id", StringType(), False),
        StructField("title", StringType()),
        StructField("abstract", StringType()),
        StructField("filing_date", DateType()),
        StructField("year", IntegerType()),
    ]),
    "inventors": StructType([
        StructField("inventor_id", StringType(), False),
        StructField("name", StringType()),
        StructField("country", StringType()),
    ]),
    "companies": StructType([
        StructField("company_id", StringType(), False),
        StructField("name", StringType()),
    ]),
    "links": StructType([
        StructField("patent_id", StringType(), False),
        StructField("inventor_id", StringType(), False),
        StructField("company_id", StringType()),
    ]),
    "cpc": StructType([
        StructField("patent_id", StringType(), False),
        StructField("section", StringType()),
        StructField("cpc_class", StringType()),
        StructField("cpc_subclass", StringType()),
    ]),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` by name onto ``schema``, casting each column."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
