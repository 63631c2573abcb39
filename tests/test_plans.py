"""Answers on a small star, checked by hand or by plain Python."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from star_rows import rows
from grantlens.plans import analysis, filtered, reports, samples, summaries, variants
from grantlens.plans.filtered import Filters
from grantlens.plans.summaries import Summaries


def test_leaderboards(small_star):
    assert [tuple(r) for r in analysis.top_inventors(small_star).collect()] == [
        ("i2", "Bob", "US", 3), ("i1", "Ann", "US", 2), ("i3", "Cid", "DE", 2), ("i4", "Ann", None, 1)
    ]
    assert [tuple(r) for r in analysis.top_companies(small_star).collect()] == [
        ("c1", "Acme", 3), ("c2", "Bolt", 2), ("c3", "Acme", 1)
    ]


def test_country_share_counts_a_patent_once_per_country(small_star):
    assert [tuple(r) for r in analysis.country_share(small_star).collect()] == [
        ("US", 4, 0.6667), ("DE", 2, 0.3333)
    ]


def test_unknown_years_drop_out_of_trends_only(small_star):
    assert rows(analysis.yearly_trend(small_star)) == [(2000, 1), (2001, 2), (2003, 1), (2004, 2)]
    assert "p5" in {r.patent_id for r in analysis.wide_join(small_star).collect()}


def test_wide_join_order_and_nulls(small_star):
    got = analysis.wide_join(small_star, 3).collect()
    assert [(r.patent_id, r.inventor_name, r.company_name) for r in got] == [
        ("p7", "Bob", "Acme"), ("p4", "Ann", "Acme"), ("p2", "Ann", "Acme")
    ]
    last = analysis.wide_join(small_star).collect()[-1]
    assert last.patent_id == "p5" and last.year is None


def test_innovation_leaders_use_the_previous_active_year(small_star):
    # peak is 2 patents; the latest year with at least 1.2 is 2004
    got = analysis.innovation_leaders(small_star, min_patents=1).collect()
    assert [tuple(r) for r in got] == [("Acme", 2004, 1, 1, 0, 0.0)]


def test_ranks_share_ties(small_star):
    got = analysis.top_inventors_by_country(small_star, 2).collect()
    assert [tuple(r) for r in got] == [("DE", 1, "Cid", 2), ("US", 1, "Bob", 3), ("US", 2, "Ann", 2)]


def test_periods_count_patents_without_links(small_star):
    got = analysis.period_comparison(small_star, [(2000, 2001), (2002, 2004)]).collect()
    assert [tuple(r) for r in got] == [("2000-2001", 3, 3, 2, 0.5), ("2002-2004", 3, 2, 2, 0.5)]


def test_growth_identities(small_star):
    for r in analysis.country_growth(small_star, min_total=0).collect():
        assert r.delta == r.second_half_patents - r.first_half_patents
        assert r.total_patents == r.second_half_patents + r.first_half_patents
    # middle of 2000..2004 is 2002
    assert {tuple(r)[:3] for r in analysis.section_growth(small_star).collect()} == {
        ("H", 2, 0), ("F", 1, 1), ("Z", 0, 1)
    }


def test_matrix_merges_homonyms(small_star):
    assert rows(analysis.company_section_matrix(small_star)) == [
        ("Acme", "F", 1), ("Acme", "H", 2), ("Acme", "Z", 1), ("Bolt", "H", 1)
    ]


def test_totals_and_sections(small_star):
    assert analysis.totals(small_star).first().asDict() == {
        "total_patents": 7, "total_inventors": 4, "total_companies": 3, "total_relationships": 8,
        "year_min": 2000, "year_max": 2004,
    }
    assert rows(analysis.section_breakdown(small_star)) == [
        ("F", 2, "Mechanical Engineering"), ("H", 2, "Electricity"), ("Z", 1, "Z")
    ]


def test_sql_text(small_star):
    got = analysis.run_sql(small_star, "SELECT COUNT(*) AS n FROM {patents} WHERE year = :y", {"y": 2001})
    assert got.first().n == 2


def test_summaries_are_written_and_read(spark, small_star, tmp_path):
    written = summaries.write_summaries(small_star, str(tmp_path))
    assert rows(summaries.audit_stored(spark, str(tmp_path))) == sorted(written.items())
    stored, derived = Summaries(small_star, str(tmp_path)), Summaries(small_star)
    for name in summaries.SUMMARIES:
        columns = sorted(derived[name].columns)
        assert rows(stored[name].select(columns)) == rows(derived[name].select(columns)), name


def test_company_totals(small_star):
    assert rows(summaries.company_total(small_star)) == [
        ("c1", "Acme", 3, 2000, 2004), ("c2", "Bolt", 1, 2001, 2001), ("c3", "Acme", 1, 2003, 2003)
    ]
    assert ("i4", "Ann", "?", 1, 2003, 2003) in rows(summaries.inventor_total(small_star))


# -- filters ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, window",
    [
        ("All time", (1976, 2025)), ("Last 5 yrs", (2020, 2025)), ("1970s", (1976, 1979)),
        ("2000s", (2000, 2009)), ("2020s", (2020, 2025)), ("nonsense", (1976, 2025)),
    ],
)
def test_presets(name, window):
    assert filtered.resolve_preset(name, 1976, 2025) == window


def test_clicked_country_is_added_once():
    f = Filters(2000, 2001, countries=("US",))
    assert f.with_country("DE").countries == ("US", "DE")
    assert f.with_country("US") is f and f.with_country(None) is f


ROUTE_FILTERS = [Filters(2000, 2004), Filters(2001, 2003), Filters(2000, 2004, min_patents=2)]


@pytest.mark.parametrize("f", ROUTE_FILTERS)
def test_routes_agree_where_sums_are_exact(small_star, f):
    s = Summaries(small_star)
    pairs = [
        (filtered.yearly(small_star, f), filtered.yearly_rollup(s, f)),
        (filtered.countries(small_star, f), filtered.countries_rollup(s, f)),
        (filtered.inventor_volumes(small_star, f), filtered.inventor_volumes_rollup(s, f)),
        (filtered.company_volumes(small_star, f), filtered.company_volumes_rollup(s, f)),
        (filtered.classes(small_star, f), filtered.classes_rollup(s, f)),
    ]
    for exact, rollup in pairs:
        assert rows(exact) == rows(rollup.select(exact.columns))


def test_rollup_over_countries_counts_shared_patents_twice(small_star):
    f = Filters(2001, 2001, countries=("US", "DE"))
    assert rows(filtered.yearly(small_star, f)) == [(2001, 2)]
    assert rows(filtered.yearly_rollup(Summaries(small_star), f)) == [(2001, 3)]


def test_class_filter_needs_both_on_one_classification(small_star):
    f = Filters(2000, 2004, sections=("H",), classes=("H02",))
    assert rows(filtered.yearly(small_star, f)) == [(2000, 1), (2001, 1)]
    assert rows(filtered.company_volumes(small_star, f)) == [("Acme", 2), ("Bolt", 1)]
    assert rows(filtered.yearly(small_star, Filters(2000, 2004, sections=("F",), classes=("H02",)))) == []


def test_overview(small_star):
    got = filtered.overview(small_star, Filters(2001, 2004, countries=("DE",))).first()
    assert got.asDict() == {"patents": 2, "inventors": 1, "companies": 1, "countries": 1}
    nothing = filtered.overview(small_star, Filters(1900, 1901)).first()
    assert nothing.asDict() == {"patents": 0, "inventors": 0, "companies": 0, "countries": 0}


def test_trends_labels(small_star):
    got = filtered.trends(small_star, Filters(2000, 2004)).collect()
    assert [(r.year, r.yoy, r.cumulative, r.direction, r.label) for r in got] == [
        (2000, None, 1, None, None), (2001, 1.0, 3, "↑ growth", "+100.0%"),
        (2003, -0.5, 4, "↓ decline", "-50.0%"), (2004, 1.0, 6, "↑ growth", "+100.0%"),
    ]
    assert filtered.latest_change(small_star).first().asDict() == {
        "year": 2004, "patents": 2, "previous": 1, "yoy": 1.0
    }


def test_search(small_star):
    f = Filters(2000, 2004)
    page = filtered.search_page(small_star, "solar", f, size=10).collect()
    assert [r.patent_id for r in page] == ["p3", "p2", "p1"]
    assert page[1].abstract_preview == "x" * 200 + "…" and page[2].abstract_preview == ""
    assert filtered.search_count(small_star, "solar", f).first().n == 3
    assert [r.patent_id for r in filtered.search_page(small_star, "solar", f, 1, 1).collect()] == ["p2"]


def test_class_tree(small_star):
    tree = filtered.class_tree(filtered.classes(small_star, Filters(2000, 2004)))
    assert [tuple(r) for r in tree.filter("depth = 0").collect()] == [(None, None, 6, 0)]
    assert {tuple(r)[::2] for r in tree.filter("depth = 1").collect()} == {
        ("Electricity", 3), ("Mechanical Engineering", 2), ("Z", 1)
    }


def test_variants(small_star):
    s = Summaries(small_star)
    assert [tuple(r) for r in variants.companies_by_name(small_star).collect()] == [("Acme", 4), ("Bolt", 2)]
    assert rows(variants.decade_volume(small_star)) == [(2000, 6, "2000s")]
    got = variants.company_cagr_by_name(s, min_total=1).collect()
    assert {r.company: r.cagr for r in got} == {"Acme": 0.0, "Bolt": None}


# -- samples and reports ------------------------------------------------------------------


def test_sample_layout_cleans_back_to_the_sampled_links(spark, small_star):
    from grantlens.plans.clean import clean_star

    quota = spark.createDataFrame([(y, 5) for y in (2000, 2001, 2003, 2004)], "year int, quota int")
    sample = samples.sample_patents(small_star, quota)
    raw = samples.sample_raw_layout(small_star, sample)
    again = clean_star(raw)
    want = small_star.links.join(sample, "patent_id", "left_semi")
    assert rows(again.links) != []
    # the raw layout lists inventors and companies apart, so the link is their product per patent
    pairs = want.select("patent_id", "inventor_id").distinct()
    assert rows(again.links.select("patent_id", "inventor_id").distinct()) == rows(pairs)
    assert rows(raw["inventors"].filter("patent_id = 'p1'").select("inventor_sequence", "inventor_id", "location_id")) == [
        (1, "i1", "loc_us"), (2, "i2", "loc_us")
    ]


def test_quota_from_a_given_list(spark):
    got = dict(rows(samples.quota_from_volumes(spark, {1976: 71, 2019: 391})))
    assert got == {1976: round(71 / 391 * 200), 2019: 200}


def test_csv_and_json_reports(spark, small_star, tmp_path):
    answers = analysis.answer_all(small_star)
    paths = reports.write_csv_reports(answers, str(tmp_path / "csv"))
    assert set(paths) == set(reports.CSV_REPORTS)
    first = next((tmp_path / "csv" / "top_companies").glob("*.csv")).read_text(encoding="utf-8")
    assert first.splitlines()[:2] == ["company_id,company_name,patent_count", "c1,Acme,3"]
    reports.write_json_report(answers, str(tmp_path / "json"))
    (part,) = (tmp_path / "json").glob("part-*.json")
    document = json.loads(part.read_text(encoding="utf-8"))
    assert document["total_patents"] == 7
    assert document["year_range"] == {"min": 2000, "max": 2004}
    assert document["top_inventors"][0] == {"name": "Bob", "country": "US", "patents": 3}
    assert [r["year"] for r in document["yearly_trends"]] == [2000, 2001, 2003, 2004]
    assert document["advanced_analytics"]["company_cagr"] == []
    assert [r["rank"] for r in document["top_ranked_inventors_by_country"]] == [1, 1, 2]
    back = reports.read_json_report(spark, str(tmp_path / "json"), "top_companies")
    assert rows(back.select("position", "name", "patents")) == [(1, "Acme", 3), (2, "Bolt", 2), (3, "Acme", 1)]


def test_console_lines(small_star):
    lines = dict(rows(reports.summary_lines(analysis.answer_all(small_star), 2)))
    assert lines == {
        "Top Inventors": "1. Bob - 3 2. Ann - 2", "Top Companies": "1. Acme - 3 2. Bolt - 2",
        "Top Countries": "1. US 2. DE",
    }


def test_a_given_quota_is_met(spark, small_star):
    patents = spark.range(1000).selectExpr("CAST(id AS STRING) AS patent_id", "2001 AS year", "'t' AS title")
    quota = spark.createDataFrame([(2001, 500)], "year int, quota int")
    assert samples.sample_patents(replace(small_star, patents=patents), quota).count() == 500


def test_more_companies_than_stored_is_an_error(small_star):
    with pytest.raises(ValueError):
        filtered.heatmap(Summaries(small_star), ["A"], companies=51)


def test_an_unlisted_category_stops_the_job(spark):
    from grantlens.operators.reshaping import pivot_counts

    cells = spark.createDataFrame([("a", "X", 1), ("a", "Y", 2), ("b", None, 3)], "row string, section string, n int")
    assert rows(pivot_counts(cells, "row", "section", "n", ["X", "Y"])) == [("a", 1, 2), ("b", 0, 0)]
    with pytest.raises(Exception, match="unlisted"):
        pivot_counts(cells, "row", "section", "n", ["X"]).collect()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from grantlens.session import shared_folder

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=context)
    with pytest.raises(ValueError):
        shared_folder(session)
