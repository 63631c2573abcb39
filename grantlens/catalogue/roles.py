"""The driver tables in the roles of the star schema, in Spark and as SQL views.

patents = orders, inventors = supplier with its nation, companies = customer,
links = distinct (order, supplier, customer) where orders of status P have no
company, classifications = distinct (order, part type, brand, brand + size).

The SQL views after these hold each (patent, entity, year) once: checking SQL counts them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.plans.summaries import Summaries
from grantlens.star import Star

ROLES_SQL = """
patents AS (
  SELECT o_orderkey AS patent_id, o_orderpriority AS title,
         CAST(o_orderdate AS DATE) AS filing_date,
         CAST(extract(year FROM o_orderdate) AS INTEGER) AS year
  FROM orders),
inventors AS (
  SELECT s_suppkey AS inventor_id, s_name AS name, n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
companies AS (SELECT c_custkey AS company_id, c_name AS name FROM customer),
patent_relationships AS (
  SELECT DISTINCT l_orderkey AS patent_id, l_suppkey AS inventor_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS company_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
patent_cpc AS (
  SELECT DISTINCT l_orderkey AS patent_id, p_type AS section, p_brand AS cpc_class,
         p_brand || CAST(p_size AS VARCHAR) AS cpc_subclass
  FROM lineitem JOIN part ON l_partkey = p_partkey),
filed AS (SELECT o_orderkey AS patent_id, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
company_filings AS (
  SELECT patent_id, o_custkey AS company_id, year FROM orders JOIN filed ON patent_id = o_orderkey
  WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)),
inventor_filings AS (
  SELECT DISTINCT patent_id, l_suppkey AS inventor_id, year
  FROM lineitem JOIN filed ON patent_id = l_orderkey),
country_filings AS (
  SELECT DISTINCT patent_id, n_name AS country, year FROM inventor_filings
  JOIN supplier ON s_suppkey = inventor_id JOIN nation ON n_nationkey = s_nationkey),
class_filings AS (
  SELECT DISTINCT patent_id, p_type AS section, p_brand AS cpc_class, year
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN filed ON patent_id = l_orderkey),
section_filings AS (SELECT DISTINCT patent_id, section, year FROM class_filings)"""

# Documents as searchable patents: the whole text is the abstract, dates come from the orders.
CORPUS_SQL = """
corpus AS (
  SELECT doc_id AS patent_id, source || ' ' || lang AS title, text AS abstract,
         CAST(o_orderdate AS DATE) AS filing_date,
         CAST(extract(year FROM o_orderdate) AS INTEGER) AS year
  FROM documents JOIN orders ON doc_id = o_orderkey)"""


# Columns of the driver tables. Naming them spares a footer-reading job per table.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """Lazy access to one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def star(self) -> Star:
        return RoleStar(self)

    @cached_property
    def summaries(self) -> Summaries:
        return Summaries(self.star)

    @cached_property
    def corpus(self) -> Star:
        return CorpusStar(self)

    @cached_property
    def coded(self) -> Star:
        return CodedStar(self)


class RoleStar(Star):
    """The star over the driver tables; each table is set up when it is first asked for."""

    def __init__(self, tables: Tables):
        object.__setattr__(self, "_tables", tables)

    @cached_property
    def patents(self) -> DataFrame:
        return self._tables["orders"].select(
            F.col("o_orderkey").alias("patent_id"),
            F.col("o_orderpriority").alias("title"),
            F.lit(None).cast("string").alias("abstract"),
            F.to_date("o_orderdate").alias("filing_date"),
            F.year("o_orderdate").alias("year"),
        )

    @cached_property
    def inventors(self) -> DataFrame:
        nations = self._tables["nation"].select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("country")
        )
        return (
            self._tables["supplier"]
            .join(nations, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("inventor_id"), F.col("s_name").alias("name"), "country"
            )
        )

    @cached_property
    def companies(self) -> DataFrame:
        return self._tables["customer"].select(
            F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name")
        )

    @cached_property
    def dated_link_rows(self) -> DataFrame:
        """Links with the order's year, from the join that makes them; rows may repeat."""
        orders = self._tables["orders"].select(
            F.col("o_orderkey").alias("patent_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("company_id"),
            F.year("o_orderdate").alias("year"),
        )
        pairs = self._tables["lineitem"].select(
            F.col("l_orderkey").alias("patent_id"), F.col("l_suppkey").alias("inventor_id")
        )
        return pairs.join(orders, "patent_id").select(
            "patent_id", "inventor_id", "company_id", "year"
        )

    @property
    def link_rows(self) -> DataFrame:
        return self.dated_link_rows.select("patent_id", "inventor_id", "company_id")

    @property
    def dated_links(self) -> DataFrame:
        return self.dated_link_rows.distinct()

    @property
    def links(self) -> DataFrame:
        return self.link_rows.distinct()

    @cached_property
    def class_rows(self) -> DataFrame:
        return (
            self._tables["lineitem"]
            .select(F.col("l_orderkey").alias("patent_id"), F.col("l_partkey").alias("p_partkey"))
            .join(
                self._tables["part"].select("p_partkey", "p_type", "p_brand", "p_size"), "p_partkey"
            )
            .select(
                "patent_id",
                F.col("p_type").alias("section"),
                F.col("p_brand").alias("cpc_class"),
                F.concat("p_brand", F.col("p_size").cast("string")).alias("cpc_subclass"),
            )
        )

    @property
    def cpc(self) -> DataFrame:
        return self.class_rows.distinct()


class CorpusStar(RoleStar):
    """Documents in the role of patents, for text search."""

    @cached_property
    def patents(self) -> DataFrame:
        dates = self._tables["orders"].select(
            F.col("o_orderkey").alias("patent_id"),
            F.to_date("o_orderdate").alias("filing_date"),
            F.year("o_orderdate").alias("year"),
        )
        documents = self._tables["documents"].select(
            F.col("doc_id").alias("patent_id"),
            F.concat("source", F.lit(" "), "lang").alias("title"),
            F.col("text").alias("abstract"),
        )
        return documents.join(dates, "patent_id")


class CodedStar(RoleStar):
    """Inventors with two-character country codes (the nation's number)."""

    @cached_property
    def inventors(self) -> DataFrame:
        return self._tables["supplier"].select(
            F.col("s_suppkey").alias("inventor_id"),
            F.col("s_name").alias("name"),
            F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("country"),
        )
