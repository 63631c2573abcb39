"""Reports, files that are written and read back, file audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from grantlens.catalogue.cleaning import RAW, _NAMES, raw_tables
from grantlens.catalogue.questions import PERIODS
from grantlens.catalogue.registry import query
from grantlens.plans import analysis, reports
from grantlens.schemas import RAW as RAW_SCHEMAS
from grantlens.session import shared_folder
from grantlens.sources import delimited, integrity, warehouse
from grantlens.sources.paths import create_empty, listing


def _fresh_folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _answers(t, *names: str) -> dict:
    built = {name: analysis.QUESTIONS[name] for name in names}
    return {name: question(t.star) for name, question in built.items()}


TOP_COMPANIES = """
top_companies AS (
  SELECT c.company_id, c.name AS company_name, COUNT(DISTINCT r.patent_id) AS patent_count
  FROM companies c JOIN patent_relationships r ON r.company_id = c.company_id
  GROUP BY c.company_id, c.name ORDER BY patent_count DESC, company_name, c.company_id LIMIT 20)"""

TOP_INVENTORS = """
top_inventors AS (
  SELECT i.inventor_id, i.name AS inventor_name, i.country, COUNT(DISTINCT r.patent_id) AS patent_count
  FROM inventors i JOIN patent_relationships r ON r.inventor_id = i.inventor_id
  GROUP BY i.inventor_id, i.name, i.country
  ORDER BY patent_count DESC, inventor_name, i.inventor_id LIMIT 20)"""

TOP_COUNTRIES = """
country_counts AS (
  SELECT i.country, COUNT(DISTINCT r.patent_id) AS patent_count
  FROM inventors i JOIN patent_relationships r ON r.inventor_id = i.inventor_id
  WHERE i.country IS NOT NULL AND i.country <> '' GROUP BY i.country),
top_countries AS (
  SELECT country, patent_count, floor(CAST(patent_count AS DOUBLE)
           / (SELECT SUM(patent_count) FROM country_counts) * 10000.0 + 0.5) / 10000.0 AS share
  FROM country_counts ORDER BY patent_count DESC, country LIMIT 15)"""


# -- report files -------------------------------------------------------------------------


@query("csv_report_roundtrip", "SELECT * FROM top_companies", TOP_COMPANIES)
def _(t):
    folder = _fresh_folder(t, "csv-report")
    top = _answers(t, "top_companies")["top_companies"]
    delimited.write_csv(reports.head(top, "top_companies", 20), folder, files=1)
    return t.spark.read.schema(top.schema).option("header", "true").csv(folder)


@query("json_report")
def _(t):
    answers = analysis.answer_all(t.star)
    answers["period_comparison"] = analysis.period_comparison(t.star, PERIODS)
    return reports.json_report(answers).select(F.to_json(F.struct("*")).alias("report"))


@query(
    "json_report_rows",
    """
SELECT row_number() OVER (ORDER BY patent_count DESC, company_name, company_id) AS position,
       company_name AS name, patent_count AS patents FROM top_companies""",
    TOP_COMPANIES,
)
def _(t):
    folder = _fresh_folder(t, "json-report")
    reports.write_json_report(analysis.answer_all(t.star), folder)
    return reports.read_json_report(t.spark, folder, "top_companies")


@query(
    "slim_records",
    "SELECT inventor_name AS name, country, patent_count AS patents FROM top_inventors",
    TOP_INVENTORS,
)
def _(t):
    return reports.slim_records(_answers(t, "top_inventors"), "top_inventors")


@query(
    "percent_labels",
    """
SELECT *, CAST(round_even(share * 1000.0, 0) / 10.0 AS VARCHAR) || ' %' AS share_pct
FROM top_countries""",
    TOP_COUNTRIES,
)
def _(t):
    return reports.with_percent(analysis.country_share(t.star), "share", "share_pct")


def _line(view: str, order: str, text: str) -> str:
    return f"""
(SELECT string_agg(n || '. ' || entry, ' ' ORDER BY n) FROM (
   SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS n, {text} AS entry FROM {view}) WHERE n <= 5)"""


@query(
    "top5_lines",
    "SELECT 'Top Inventors' AS title,"
    + _line("top_inventors", "patent_count DESC, inventor_name, inventor_id",
            "inventor_name || ' - ' || patent_count")
    + " AS line\nUNION ALL SELECT 'Top Companies',"
    + _line("top_companies", "patent_count DESC, company_name, company_id",
            "company_name || ' - ' || format('{:,}', patent_count)")
    + "\nUNION ALL SELECT 'Top Countries',"
    + _line("top_countries", "patent_count DESC, country", "country"),
    TOP_INVENTORS + "," + TOP_COMPANIES + "," + TOP_COUNTRIES,
)
def _(t):
    return reports.summary_lines(_answers(t, "top_inventors", "top_companies", "country_share"))


# -- tables on disk -----------------------------------------------------------------------


@query(
    "tsv_scan_roundtrip",
    """
SELECT patent_id, NULLIF(patent_date, '') AS patent_date, patent_title,
       patent_abstract, CAST(NULL AS VARCHAR) AS wipo_kind
FROM raw_patents""",
    f"raw_patents AS ({RAW['patents'].format(**{n: n for n in _NAMES})})",
)
def _(t):
    folder = _fresh_folder(t, "tsv")
    delimited.write_tsv(raw_tables(t)["patents"], folder)
    back = delimited.scan(t.spark, folder, RAW_SCHEMAS["patents"])
    return back.select("patent_id", "patent_date", "patent_title", "patent_abstract", "wipo_kind")


@query(
    "warehouse_roundtrip",
    """
SELECT p.year, CAST(r.patent_id AS VARCHAR) AS patent_id,
       CAST(r.inventor_id AS VARCHAR) AS inventor_id, CAST(r.company_id AS VARCHAR) AS company_id
FROM patent_relationships r JOIN patents p ON p.patent_id = r.patent_id WHERE p.year >= 1999""",
)
def _(t):
    folder = _fresh_folder(t, "warehouse")
    warehouse.write_star(t.star, folder)
    stored = warehouse.read_star(t.spark, folder)
    return stored.activity.filter(F.col("year") >= 1999)


@query(
    "written_row_counts",
    """
SELECT 'patents' AS table_name, COUNT(*) AS rows FROM patents
UNION ALL SELECT 'inventors', COUNT(*) FROM inventors
UNION ALL SELECT 'companies', COUNT(*) FROM companies
UNION ALL SELECT 'links', COUNT(*) FROM patent_relationships
UNION ALL SELECT 'cpc', COUNT(*) FROM patent_cpc""",
)
def _(t):
    counts = warehouse.write_star(t.star, _fresh_folder(t, "warehouse"))
    return t.spark.createDataFrame(list(counts.items()), "table_name string, rows long")


# -- file audits --------------------------------------------------------------------------

# Documents as files, one for each source and language: lines in the order of their ids. The record was taken
# of an earlier version: one source came later, one had other texts, one has gone since. Both have an empty file.
_LATER, _CHANGED, _GONE = "src1", "src2", "src3"

_RECORD = f"""
files AS (
  SELECT 'csv/source=' || source || '/lang=' || lang AS path, source,
         string_agg(text || chr(10), '' ORDER BY doc_id) AS now,
         string_agg(CASE WHEN source = '{_CHANGED}' THEN text || '.' ELSE text END || chr(10), '' ORDER BY doc_id) AS before
  FROM documents GROUP BY source, lang
  UNION ALL SELECT 'csv/source=none/lang=none', '', '', ''),
recorded AS (
  SELECT path, octet_length(encode(before)) AS bytes, sha256(before) AS sha256 FROM files WHERE source <> '{_LATER}'),
present AS (
  SELECT path, octet_length(encode(now)) AS bytes, sha256(now) AS sha256 FROM files WHERE source <> '{_GONE}')"""


def _write_version(docs, folder: str) -> None:
    """A text file for each source and language, and an empty one."""
    rows = docs.select("doc_id", "source", "lang", "text").repartition("source", "lang").sortWithinPartitions("source", "lang", "doc_id")
    # one task writes a folder, in the order of its rows
    rows.drop("doc_id").write.partitionBy("source", "lang").text(f"{folder}/csv")
    create_empty(docs.sparkSession, f"{folder}/csv/source=none/lang=none/part-0.txt")


def _hashed(t, folder: str):
    """(path, bytes, sha256) of the files below a folder, named by the folders they lie in."""
    found = integrity.checksums(listing(t.spark, folder, "part-*"))
    name = F.regexp_extract("path", "(csv/.*)/[^/]*$", 1)
    return found.select(name.alias("path"), "bytes", "sha256")


def _files_of(t) -> tuple:
    """What was recorded of the earlier version, and what is there now."""
    docs, folder = t["documents"], _fresh_folder(t, "files")
    text = F.when(F.col("source") == _CHANGED, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    _write_version(docs.filter(F.col("source") != _LATER).withColumn("text", text), f"{folder}/v1")
    _write_version(docs.filter(F.col("source") != _GONE), f"{folder}/v2")
    record = f"{folder}/record"
    integrity.record_loaded(_hashed(t, f"{folder}/v1"), record)
    return integrity.read_load_record(t.spark, record), _hashed(t, f"{folder}/v2")


@query(
    "file_integrity_audit",
    """
SELECT r.path, CASE WHEN p.path IS NULL THEN 'missing' WHEN p.sha256 = r.sha256 AND p.bytes = r.bytes THEN 'ok'
                    ELSE 'mismatch' END AS status
FROM recorded r LEFT JOIN present p ON p.path = r.path""",
    _RECORD,
)
def _(t):
    """Files are written, listed and hashed in tasks, and held against the record of their earlier version."""
    recorded, present = _files_of(t)
    return integrity.audit(integrity.choose_format(recorded, "both"), present)


@query("pending_files", "SELECT p.* FROM present p WHERE (p.path, p.bytes) NOT IN (SELECT (path, bytes) FROM recorded)", _RECORD)
def _(t):
    recorded, present = _files_of(t)
    return integrity.pending(present, recorded)


@query("pending_files_forced", "SELECT * FROM present", _RECORD)
def _(t):
    recorded, present = _files_of(t)
    return integrity.pending(present, recorded, force=True)
