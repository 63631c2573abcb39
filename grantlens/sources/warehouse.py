"""The stored star schema and its summary tables.

Layout for large data: the two facts carry the patent's year and are written
partitioned by it, so year windows become folder pruning. Before the write, rows are
rebalanced on the year: Spark joins small years into one task and splits large
ones, so neither many tiny files nor one huge file comes out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from grantlens.schemas import CLEAN, conform
from grantlens.sources.paths import exists
from grantlens.sources.snapshots import ROWS_PER_FILE, Snapshot, snapshot
from grantlens.star import Star

CLEAN_TABLES = ("patents", "inventors", "companies", "links", "cpc")

# Names of the clean CSV files read when a table has no Parquet form.
CSV_NAMES = {
    "patents": "clean_patents.csv",
    "inventors": "clean_inventors.csv",
    "companies": "clean_companies.csv",
    "links": "clean_relationships.csv",
    "cpc": "clean_cpc.csv",
}

# Tables that carry the patent's year and are stored by it.
FACTS = ("links", "cpc")


def write_counted(df: DataFrame, path: str, by_year: bool = False) -> int:
    """Write Parquet and return the row count, observed in the same pass."""
    seen = Observation()
    out = df.hint("rebalance", F.col("year")) if by_year else df
    writer = (
        out.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )
    (writer.partitionBy("year") if by_year else writer).parquet(path)
    return seen.get["rows"]


# What stored facts may carry beside their own columns.
EXTRAS = StructType([
    StructField("country", StringType()),
    StructField("one_per_inventor", BooleanType()),
    StructField("one_per_company", BooleanType()),
    StructField("one_per_country", BooleanType()),
    StructField("one_per_section", BooleanType()),
    StructField("year", IntegerType()),
])


def _fact_schema(name: str, columns: list[str]) -> StructType:
    extras = [field for field in EXTRAS if field.name in columns]
    return StructType([*CLEAN[name].fields, *extras])


def write_clean_table(df: DataFrame, folder: str, name: str) -> int:
    """Write one clean table; facts must come with their year."""
    if name in FACTS:
        schema = _fact_schema(name, df.columns)
        return write_counted(conform(df, schema), f"{folder}/{name}", by_year=True)
    return write_counted(conform(df, CLEAN[name]), f"{folder}/{name}")


def write_star(star: Star, folder: str) -> dict[str, int]:
    """Write the clean tables; returns written rows per table."""
    tables = {
        "patents": star.patents,
        "inventors": star.inventors,
        "companies": star.companies,
        "links": star.dated_links if star.dated_links is not None else star.dated_link_rows,
        "cpc": star.dated_cpc if star.dated_cpc is not None else star.dated_class_rows.distinct(),
    }
    return {name: write_clean_table(df, folder, name) for name, df in tables.items()}


def read_clean_table(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """Parquet when there is one, else CSV (short rows are padded with NULL), else nothing."""
    schema = CLEAN[name]
    parquet = f"{folder}/{name}"
    if exists(spark, parquet):
        stored = spark.read.parquet(parquet)
        if name in FACTS:
            schema = _fact_schema(name, stored.columns)
        return conform(stored, schema)
    csv = f"{folder}/{CSV_NAMES[name]}"
    if exists(spark, csv):
        reader = (
            spark.read.schema(schema)
            .option("header", "true")
            .option("quote", '"')
            .option("escape", '"')
            .option("dateFormat", "yyyy-MM-dd")
            .option("mode", "PERMISSIVE")
        )
        return reader.csv(csv)
    return None


def snapshot_star(spark: SparkSession, opened: Snapshot) -> Star:
    """The clean tables of one snapshot; None for those it was not to keep, so that asking for them fails."""
    stored = {name: opened.read(spark, name) if name in opened.parts else None for name in CLEAN_TABLES}
    tables = {name: None if df is None else df.select(CLEAN[name].names) for name, df in stored.items()}
    return Star(**tables, **{f"dated_{name}": stored[name] for name in FACTS}).as_opened()


def read_star(spark: SparkSession, folder: str, number: int | None = None) -> Star:
    """Open the newest snapshot of a folder, or the one of a number.

    The star stays on that snapshot, whatever is committed later. A folder without snapshots holds plain tables, and
    a missing one is empty.
    """
    found = snapshot(spark, folder, number)
    if found is not None:
        return snapshot_star(spark, found)
    tables = {}
    for name in CLEAN_TABLES:
        table = read_clean_table(spark, folder, name)
        tables[name] = spark.createDataFrame([], CLEAN[name]) if table is None else table
    for name in FACTS:
        if "year" in tables[name].columns:
            tables[f"dated_{name}"] = tables[name]
            tables[name] = tables[name].select(CLEAN[name].names)
    return Star(**tables).as_opened()


def save_table(df: DataFrame, name: str) -> None:
    """Save as a catalogue table and compute the statistics the cost-based optimiser reads."""
    df.write.mode("overwrite").option("compression", "zstd").saveAsTable(name)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
