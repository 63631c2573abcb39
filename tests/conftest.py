import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grantlens.session import build_session  # noqa: E402
from grantlens.star import Star  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalogue")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_star(spark):
    """Seven patents, four inventors (one without a country), three companies, two homonyms."""
    patents = spark.createDataFrame(
        [
            ("p1", "solar cell", None, "2000-01-10", 2000),
            ("p2", "Solar panel", "x" * 250, "2001-02-10", 2001),
            ("p3", "engine", "a SOLAR engine", "2001-03-10", 2001),
            ("p4", "engine 100% new", None, "2003-01-10", 2003),
            ("p5", None, None, None, None),
            ("p6", "lonely", None, "2004-05-01", 2004),
            ("p7", "pump", None, "2004-06-01", 2004),
        ],
        "patent_id string, title string, abstract string, d string, year int",
    ).selectExpr("patent_id", "title", "abstract", "CAST(d AS DATE) AS filing_date", "year")
    inventors = spark.createDataFrame(
        [("i1", "Ann", "US"), ("i2", "Bob", "US"), ("i3", "Cid", "DE"), ("i4", "Ann", None)],
        "inventor_id string, name string, country string",
    )
    companies = spark.createDataFrame(
        [("c1", "Acme"), ("c2", "Bolt"), ("c3", "Acme")], "company_id string, name string"
    )
    links = spark.createDataFrame(
        [
            ("p1", "i1", "c1"), ("p1", "i2", "c1"), ("p2", "i1", "c1"), ("p2", "i3", "c2"),
            ("p3", "i3", None), ("p4", "i4", "c3"), ("p5", "i2", "c2"), ("p7", "i2", "c1"),
        ],
        "patent_id string, inventor_id string, company_id string",
    )
    cpc = spark.createDataFrame(
        [
            ("p1", "H", "H01", "H01L"), ("p1", "H", "H02", "H02S"), ("p2", "H", "H02", "H02S"),
            ("p3", "F", "F02", "F02B"), ("p4", "F", "F02", "F02C"), ("p7", None, None, None),
            ("p7", "Z", "Z99", None),
        ],
        "patent_id string, section string, cpc_class string, cpc_subclass string",
    )
    return Star(patents, inventors, companies, links, cpc)
