"""Planted dirt and the exact rows it must become."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from star_rows import rows
from grantlens.plans import analysis, checks, clean
from grantlens.plans.clean import (
    clean_inventors,
    clean_links,
    clean_star,
    mark_cpc,
    mark_links,
)
from grantlens.sources import synthetic
from grantlens.sources.delimited import read_raw
from grantlens.plans.refresh import build_warehouse
from grantlens.sources.warehouse import read_star

FILES = {
    "g_patent.tsv": (
        "patent_id\tpatent_type\tpatent_date\tpatent_title\tpatent_abstract\twipo_kind\tnum_claims\twithdrawn\tfilename\n"
        "0123\tutility\t2010-05-01\t  Folding   ladder \tAn   abstract\tB2\t1\t0\tf\n"
        "200\tutility\t\tNo date\t\tB2\t1\t0\tf\n"
        "300\tutility\t2020\tPartial date\tNULL\tB2\t1\t0\tf\n"
        "301\tutility\t2020-13-01\tBad date\tnull\tB2\t1\t0\tf\n"
        "400\tutility\t1970-01-01\tToo old\tx\tB2\t1\t0\tf\n"
        "500\tutility\t2012-01-01\tLater copy\tx\tB2\t1\t0\tf\n"
        "500\tutility\t2011-01-01\tEarlier copy\ty\tB2\t1\t0\tf\n"
        "500\tutility\t\tUndated copy\tz\tB2\t1\t0\tf\n"
        "600\tutility\t2013-01-01\t \tq\tB2\t1\t0\tf\n"
        "\tutility\t2013-01-01\tNo id\tq\tB2\t1\t0\tf\n"
        "700\tutility\t1960-01-01\tOld copy\tq\tB2\t1\t0\tf\n"
        "700\tutility\t2014-01-01\tNew copy\tq\tB2\t1\t0\tf\n"
    ),
    "g_inventor_disambiguated.tsv": (
        "patent_id\tinventor_sequence\tinventor_id\tdisambig_inventor_name_first\tdisambig_inventor_name_last\tgender_code\tlocation_id\n"
        "0123\t1\ta\tAnn\tLee\t\tL1\n"
        "0123\t2\t b \tBob\t\t\tL2\n"
        "0123\t3\tc\tCid\tFox\t\tL3\n"
        "200\t1\ta\tAnna\tLee\t\tL2\n"
        "500\t1\t\tNo\tId\t\tL1\n"
        "500\t2\td\t\t\t\tL4\n"
        "500\t3\td\tDan\tKim\t\tL9\n"
        "400\t1\te\tEve\tOld\t\tL1\n"
        "600\t1\tc\tCid\tFox\t\tL1\n"
        "600\t1\tc\tCid\tFox\t\tL1\n"
    ),
    "g_assignee_disambiguated.tsv": (
        "patent_id\tassignee_sequence\tassignee_id\tdisambig_assignee_individual_name_first\tdisambig_assignee_individual_name_last\tdisambig_assignee_organization\tassignee_type\tlocation_id\n"
        "0123\t1\tX\t\t\tXenon\t2\tL1\n"
        "0123\t2\tY\tYan\tYu\t\t4\tL1\n"
        "500\t1\tN\t\t\t\t2\tL1\n"
        "500\t2\tM\t\t\t\t2\tL1\n"
        "600\t1\tX\t\t\tAlpha\t2\tL1\n"
    ),
    "g_location_disambiguated.tsv": (
        "location_id\tdisambig_city\tdisambig_state\tdisambig_country\tlatitude\tlongitude\tcounty\tstate_fips\tcounty_fips\n"
        "L1\t\t\t us \t\t\t\t\t\n"
        "L2\t\t\tDE\t\t\t\t\t\n"
        "L3\t\t\tfr\t\t\t\t\t\n"
        "L4\t\t\t\t\t\t\t\t\n"
    ),
    "g_cpc_current.tsv": (
        "patent_id\tcpc_sequence\tcpc_section\tcpc_class\tcpc_subclass\tcpc_group\tcpc_type\n"
        "0123\t1\tA\tA01\tA01B\tA01B1/00\tinv\n"
        "0123\t2\tA\tA01\tA01B\tA01B2/00\tinv\n"
        "0123\t3\t \tB01\tB01D\tg\tinv\n"
        "0123\t4\t\tC01\tC01B\tg\tinv\n"
        "400\t1\tA\tA01\tA01B\tg\tinv\n"
        "600\t1\tG\tG06\t\tg\tinv\n"
    ),
}


@pytest.fixture
def folder(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_text(content, encoding="utf-8")
    return tmp_path


@pytest.fixture
def star(spark, folder):
    return clean_star(read_raw(spark, str(folder)))


def test_patents(star):
    assert rows(star.patents) == sorted([
        ("0123", "Folding ladder", "An abstract", date(2010, 5, 1), 2010),
        ("200", "No date", None, None, None),
        ("300", "Partial date", None, None, None),
        ("301", "Bad date", None, None, None),
        ("500", "Earlier copy", "y", date(2011, 1, 1), 2011),
        ("600", None, "q", date(2013, 1, 1), 2013),
        # the copy outside the window is gone before copies are compared
        ("700", "New copy", "q", date(2014, 1, 1), 2014),
    ], key=repr)


def test_inventors(star, spark, folder):
    # a: a tie of US and DE goes to the smaller; d: a blank name sorts first; e: old patent, kept
    assert rows(star.inventors) == sorted([
        ("a", "Ann Lee", "DE"), ("b", "Bob", "DE"), ("c", "Cid Fox", "US"), ("d", None, None),
        ("e", "Eve Old", "US"),
    ], key=repr)
    raw = read_raw(spark, str(folder))
    named = clean_inventors(raw["inventors"], raw["locations"], prefer_named=True)
    assert ("d", "Dan Kim", None) in rows(named)
    assert rows(clean_inventors(raw["inventors"]).select("country").distinct()) == [(None,)]


def test_companies(star):
    assert rows(star.companies) == [("X", "Alpha"), ("Y", "Yan Yu")]


def test_links(star):
    assert rows(star.links) == sorted([
        *[("0123", i, c) for i in "abc" for c in "XY"],  # three inventors x two assignees
        ("200", "a", None),  # no assignee
        ("500", "d", None),  # two nameless assignees become one NULL
        ("600", "c", "X"),
    ], key=repr)


def test_links_check_foreign_inventors(spark, folder, star):
    raw = read_raw(spark, str(folder))
    known = star.inventors.filter("inventor_id != 'a'")
    links = clean_links(raw["inventors"], raw["assignees"], star.patents, star.companies, known)
    assert "a" not in {r[1] for r in rows(links)}


def test_cpc(star):
    assert rows(star.cpc) == sorted([
        ("0123", "A", "A01", "A01B"), ("0123", None, "B01", "B01D"), ("600", "G", "G06", None),
    ], key=repr)


def test_optional_files_and_columns(spark, folder):
    (folder / "g_location_disambiguated.tsv").unlink()
    (folder / "g_cpc_current.tsv").unlink()
    without = [
        "\t".join(c for k, c in enumerate(line.split("\t")) if k != 4)
        for line in FILES["g_patent.tsv"].splitlines()
    ]
    (folder / "g_patent.tsv").write_text("\n".join(without) + "\n", encoding="utf-8")
    star = clean_star(read_raw(spark, str(folder)))
    assert star.cpc.count() == 0 and star.cpc.columns == ["patent_id", "section", "cpc_class", "cpc_subclass"]
    assert rows(star.inventors.select("country").distinct()) == [(None,)]
    assert rows(star.patents.select("abstract").distinct()) == [(None,)]
    assert star.patents.count() == 7


def test_warehouse_build_equals_the_lazy_star(spark, folder, star, tmp_path):
    out = str(tmp_path / "warehouse")
    counts = build_warehouse(read_raw(spark, str(folder)), out)
    assert counts == {"patents": 7, "inventors": 5, "companies": 2, "links": 9, "cpc": 3}
    stored = read_star(spark, out)
    for table in counts:
        assert rows(getattr(stored, table)) == rows(getattr(star, table)), table
    assert rows(stored.activity.select("patent_id").distinct()) == [("0123",), ("500",), ("600",)]


def test_flags_give_the_distinct_pairs(spark):
    """The stored flags and the plain distinct must find the same pairs."""
    raw = synthetic.raw_tables(spark, 0.4)
    star = clean_star(raw)
    marked = mark_links(star.dated_links, star.inventors).cache()
    classes = mark_cpc(star.dated_cpc).cache()
    assert classes.count() == star.cpc.count()
    stored = replace(star, dated_links=marked, dated_cpc=classes).as_opened()
    assert marked.count() == star.links.count()
    for dated in (False, True):
        for key in ("inventor_id", "company_id"):
            assert rows(stored.patents_of(key, dated)) == rows(star.patents_of(key, dated))
        assert rows(stored.patents_in_countries(dated)) == rows(star.patents_in_countries(dated))
        assert rows(stored.patents_in_sections(dated)) == rows(star.patents_in_sections(dated))
    for limit in (1, 20):
        want = [tuple(r) for r in analysis.wide_join(star, limit).collect()]
        assert [tuple(r) for r in analysis.wide_join(stored, limit).collect()] == want
    plan = stored.patents_of("inventor_id")._jdf.queryExecution().executedPlan().toString()
    assert "one_per_inventor" in plan
    # a replaced table is believed, not what was stored beside the old one
    some = star.inventors.filter(F.pmod(F.xxhash64("inventor_id"), F.lit(3)) == 0)
    few = star.links.filter(F.pmod(F.xxhash64("patent_id"), F.lit(2)) == 0)
    for table, kept in (("inventors", some), ("links", few)):
        changed = replace(stored, **{table: kept})
        plain = replace(star, dated_links=None, **{table: kept})
        want = [tuple(r) for r in analysis.wide_join(plain, 50).collect()]
        assert [tuple(r) for r in analysis.wide_join(changed, 50).collect()] == want and len(want) == 50
        assert rows(changed.patents_in_countries(True)) == rows(plain.patents_in_countries(True))
        assert rows(changed.patents_of("company_id")) == rows(plain.patents_of("company_id"))


def test_clean_star_passes_its_checks(star):
    report = {(r[0], r[1]): r[2] for r in checks.quality_report(star, 1976, 2025).collect()}
    # the fixture has two countries only, one fewer than a real corpus must have
    assert {check for check, n in report.items() if n} == {("inventors", "country_variety")}


def test_patents_are_parsed_before_one_sort(spark):
    """Rows are sorted once, after the shuffle, and the filter on the year names the date once."""
    raw = spark.createDataFrame(
        [("p1", "\t1999-01-02 \n", "a"), ("p1", "\x0b1998/3/4\f", "b"), ("p2", "2001-01-01", "c"), ("p3", "1995-12-31", "d"),
         ("p4", "1996-01-01", "e"), ("p5", "2000-12-31", "f"), ("p6", "1998", "g")],
        "patent_id string, patent_date string, patent_title string").localCheckpoint()
    found = clean.clean_patents(raw, 1996, 2000)
    assert sorted((r[0], r[1], r[4]) for r in found.collect()) == [
        ("p1", "b", 1998), ("p4", "e", 1996), ("p5", "f", 2000), ("p6", "g", None)]
    plan = clean.clean_patents(raw, 1996, 2000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert plan.count("patent_date#") == 4  # the scan, the filter, and the date and the year, which one parse serves
