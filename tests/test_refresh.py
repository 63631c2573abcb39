"""Snapshots and refreshes: what a stopped build leaves behind, and refreshed stars against full builds."""

import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantlens.plans import checks, clean, refresh, summaries
from grantlens.schemas import RAW
from grantlens.sources import snapshots, synthetic
from grantlens.sources.warehouse import read_star, snapshot_star
from star_rows import rows

# The columns the rows below give.
COLUMNS = {
    "patents": ["patent_id", "patent_date", "patent_title"],
    "inventors": ["patent_id", "inventor_id", "disambig_inventor_name_first", "location_id"],
    "assignees": ["patent_id", "assignee_id", "disambig_assignee_organization"],
    "locations": ["location_id", "disambig_country"],
    "cpc": ["patent_id", "cpc_section", "cpc_class"],
}
FIRST = {
    "patents": [("p1", "2000-01-01", "one"), ("p2", "2001-01-01", "two"), ("p3", "2001-05-01", "three"), ("p4", "1990-01-01", "old"),
                ("p5", None, "undated"), ("p6", "2003-01-01", "six")],
    "inventors": [("p1", "i1", "Zoe", "l1"), ("p1", "i2", "Bob", "l2"), ("p2", "i1", "Zoe", "l1"), ("p3", "i3", "Cid", "l3"),
                  ("p5", "i2", "Bob", "l2"), ("p6", "i3", "Cid", "l9"), ("p9", "i9", "Nil", None)],
    "assignees": [("p1", "c1", None), ("p2", "c1", None), ("p3", "c2", "Bolt"), ("p6", "c2", "Bolt")],
    "locations": [("l1", "us"), ("l2", "de"), ("l3", " ")],
    "cpc": [("p1", "A", "A01"), ("p2", "B", "B01"), ("p3", "A", "A01"), ("p6", "C", None)],
}
# each list of rows moves something the first load decided
SECOND = {
    "earlier date": {"patents": [("p2", "2000-06-01", "two again")]},
    "leaves the window": {"patents": [("p3", "1950-01-01", "three"), ("p4", "2002-01-01", "new")]},
    "named at last": {"assignees": [("p6", "c1", "Acme")]},
    "smaller name": {"inventors": [(" p6 ", " i1 ", "Ann", "l1")], "assignees": [("p9", "c2", "Alpha")]},
    "another country": {"locations": [("l3", "fr")]},
    "country by more rows": {"inventors": [("p8", "i1", "Zoe", "l2"), ("p8", "i1", "Zoe", "l2"), ("p8", "i1", "Zoe", "l2")]},
    "everything new": {"patents": [("p7", "2005-01-01", "seven")], "inventors": [("p7", "i7", "New", "l7")],
                       "assignees": [("p7", "c7", "Corp")], "locations": [("l7", "jp")], "cpc": [("p7", "H", "H01")]},
    "classes": {"cpc": [("p1", "A", "A00"), ("p1", "A", "A01"), ("p5", "G", "G01")]},
    "blanks": {"patents": [(None, "2001-01-01", "x"), (" ", None, None)], "inventors": [("p1", " ", "Who", "l1"), (None, "i1", "Aaa", None)],
               "assignees": [("p1", None, "Nobody")], "cpc": [(None, "A", "A01"), ("p1", None, "A01")], "locations": [(None, "us")]},
}


def frames(spark, tables):
    return {name: spark.createDataFrame(tables.get(name, []), ", ".join(f"{c} string" for c in COLUMNS[name])) for name in RAW}


def copier(spark, base, **options):
    """A function that makes copies of a folder with the first load, to be refreshed."""
    refresh.load(frames(spark, FIRST), str(base), 1976, 2025, **options)

    def copy(name):
        target = base.parent / name
        shutil.copytree(base, target)
        return str(target)

    return copy


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    return copier(spark, tmp_path_factory.mktemp("star") / "base")


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    """Without summary tables."""
    return copier(spark, tmp_path_factory.mktemp("plain") / "base", summarised=False)


def content(spark, folder):
    found = snapshots.snapshot(spark, folder)
    names = [n for n in ("patents", "inventors", "companies", "links", "cpc", *summaries.SUMMARIES) if n in found.parts]
    out = {}
    for name in names:
        df = found.read(spark, name)
        out[name] = rows(df.select(sorted(c for c in df.columns if c != "bucket")))
    return out


def test_refreshes_equal_a_full_build(spark, loaded, tmp_path):
    """Two loads, each of which moves several things at once, and one of nothing."""
    folder, whole = loaded("refreshed"), str(tmp_path / "whole")
    names = sorted(SECOND)
    loads = [names[::2], names[1::2], []]
    both = {name: list(FIRST[name]) for name in RAW}
    for number, chosen in enumerate(loads, 2):
        more = {name: [r for case in chosen for r in SECOND[case].get(name, [])] for name in RAW}
        assert refresh.load(frames(spark, more), folder, 1976, 2025).number == number
        both = {name: both[name] + more[name] for name in RAW}
    refresh.build(frames(spark, both), whole, 1976, 2025)
    got, want = content(spark, folder), content(spark, whole)
    for name in want:
        assert got[name] == want[name], name


def test_only_touched_years_and_buckets_are_written(spark, loaded):
    folder = loaded("touched")
    before = snapshots.snapshot(spark, folder)
    after = refresh.load(frames(spark, {"patents": [("p7", "2003-07-01", "x")], "cpc": [("p7", "H", "H01")]}), folder, 1976, 2025)
    for table in ("patents", "links", "cpc", "mv_yearly", "mv_inventor_yearly"):
        moved = set(after.parts[table]) - set(before.parts[table])
        assert all(p.startswith("year=2003/") for p in moved), table
    assert after.parts["inventors"] == before.parts["inventors"]
    assert any(p.startswith("year=2003/") and p not in before.parts["patents"] for p in after.parts["patents"])


def test_a_stopped_build_leaves_the_star_it_found(spark, plain, monkeypatch):
    folder = plain("stopped")
    before = content(spark, folder)
    write = snapshots.Draft.write

    def stop(self, df, table, by=None):
        if table == "cpc":
            raise OSError("the driver is lost")
        return write(self, df, table, by)

    monkeypatch.setattr(snapshots.Draft, "write", stop)
    with pytest.raises(OSError):
        refresh.load(frames(spark, SECOND["everything new"]), folder, 1976, 2025)
    monkeypatch.undo()
    assert snapshots.numbers(spark, folder) == [1] and content(spark, folder) == before
    # run again: files of the stopped attempt are not met, and a star opened before stays on its snapshot
    old = read_star(spark, folder)
    assert refresh.load(frames(spark, SECOND["everything new"]), folder, 1976, 2025).number == 2
    assert old.patents.count() == 6 and read_star(spark, folder).patents.count() == 7
    assert rows(read_star(spark, folder, 1).patents) == rows(old.patents)
    # what the newest snapshot does not name goes
    want = content(spark, folder)
    assert snapshots.drop_unreferenced(spark, folder) > 0
    assert content(spark, folder) == want and snapshots.numbers(spark, folder) == [2]
    assert snapshots.drop_unreferenced(spark, folder) == 0


def test_two_builds_at_once_conflict(spark, plain):
    folder = plain("conflict")
    slow, fast = (snapshots.snapshot(spark, folder).next() for _ in range(2))
    fast.commit(spark)
    with pytest.raises(snapshots.CommitConflict):
        slow.commit(spark)
    assert snapshots.numbers(spark, folder) == [1, 2]


def test_facts_of_a_snapshot_prune_years(spark, plain):
    star = read_star(spark, plain("pruned"))
    plan = star.activity.filter("year >= 2003")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "Join" not in plan
    assert rows(star.activity.filter("year >= 2003").select("patent_id")) == [("p6",)]


def test_quality_report_reads_tables_once(spark, plain):
    star = read_star(spark, plain("checked"))
    report = checks.quality_report(star, 1976, 2025)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 6  # five tables, inventors twice
    found = {(r["table_name"], r["check_name"]): r["failures"] for r in report.collect()}
    assert len(found) == 17 and {k for k, n in found.items() if n} == {("inventors", "country_fill"), ("inventors", "country_variety")}


def test_few_and_many_touched_patents_give_the_same_star(spark, plain, monkeypatch):
    more = {name: [r for case in sorted(SECOND) for r in SECOND[case].get(name, [])] for name in RAW}
    got = []
    for many in (0, 1000):
        monkeypatch.setattr(refresh, "MANY", many)
        folder = plain(f"many-{many}")
        refresh.load(frames(spark, more), folder, 1976, 2025)
        got.append(content(spark, folder))
    assert got[0] == got[1]


def test_a_build_of_facts_shuffles_each_raw_table_once_by_patent(spark):
    """Marked links equal the plain links marked afterwards, without joins of the choices back to the links."""
    raw = synthetic.raw_tables(spark, 0.4)
    star = clean.clean_star(raw)
    args = (raw["inventors"], raw["assignees"], star.patents, star.companies)
    got = clean.marked_links(*args, star.inventors)
    assert rows(got) == rows(clean.mark_links(clean.clean_links(*args), star.inventors))
    got = clean.marked_cpc(raw["cpc"], star.patents).groupBy("patent_id", "section").agg(
        F.count("*"), F.sum(F.col("one_per_section").cast("int")))
    want = clean.mark_cpc(clean.clean_cpc(raw["cpc"], star.patents)).groupBy("patent_id", "section").agg(
        F.count("*"), F.sum(F.col("one_per_section").cast("int")))
    assert rows(got) == rows(want)
    stored = [df.localCheckpoint() for df in (raw["inventors"], raw["assignees"], star.patents, star.companies, star.inventors)]
    plan = clean.marked_links(*stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Join") == 4 and "HashAggregate" not in plan
    plan = clean.marked_cpc(raw["cpc"].localCheckpoint(), stored[2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Join") == 1 and plan.count("Sort [") <= 2


def test_a_load_of_very_many_rows_looks_nothing_up(spark, loaded, tmp_path, monkeypatch):
    """Half of the raw rows after the other half: no touched ids are found, joined or put aside."""
    asked, stage, some = [], snapshots.Draft.stage, refresh._of

    def staged(self, df, name):
        asked.append(name)
        return stage(self, df, name)

    def chosen(df, column, ids):
        asked.extend([] if ids is None else [column])
        return some(df, column, ids)

    monkeypatch.setattr(snapshots.Draft, "stage", staged)
    monkeypatch.setattr(refresh, "_of", chosen)
    more = {name: FIRST[name] + [r for case in sorted(SECOND) for r in SECOND[case].get(name, [])] for name in RAW}
    folder, whole = loaded("very-many"), str(tmp_path / "whole")
    refresh.load(frames(spark, more), folder, 1976, 2025)
    assert asked == []
    refresh.build(frames(spark, {name: FIRST[name] + more[name] for name in RAW}), whole, 1976, 2025)
    got, want = content(spark, folder), content(spark, whole)
    for name in want:
        assert got[name] == want[name], name


def test_a_star_of_some_tables_keeps_only_what_they_need(spark, loaded, tmp_path, monkeypatch):
    """Two loads of some tables equal the same tables of all, few touched or many."""
    more = {name: [r for case in sorted(SECOND) for r in SECOND[case].get(name, [])] for name in RAW}
    folder = loaded("all-tables")
    refresh.load(frames(spark, more), folder, 1976, 2025)
    want = content(spark, folder)
    for wanted, raws, many in (
        (["mv_yearly"], {"patents"}, 0.5), (["mv_section_yearly"], {"patents", "cpc"}, 1000),
        (["inventors", "companies"], {"inventors", "assignees", "locations"}, 1000), (["links"], set(RAW) - {"cpc"}, 1000),
    ):
        monkeypatch.setattr(refresh, "MANY", many)
        target = str(tmp_path / wanted[0])
        refresh.load(frames(spark, FIRST), target, 1976, 2025, tables=wanted)
        after = refresh.load(frames(spark, more), target, 1976, 2025)
        got = content(spark, target)
        assert set(got) == refresh.with_sources(wanted)
        assert got == {table: want[table] for table in got}, wanted
        assert {p for p in after.parts if p.startswith("raw_")} == {f"raw_{r}" for r in raws}, wanted
    with pytest.raises(ValueError, match="no such tables"):
        refresh.load(frames(spark, FIRST), str(tmp_path / "wrong"), 1976, 2025, tables=["patent"])


def test_summaries_name_the_tables_they_read(spark, loaded):
    opened = snapshots.snapshot(spark, loaded("sources"))
    assert summaries.MADE_FROM.keys() == summaries.SUMMARIES.keys()
    for name, build in summaries.SUMMARIES.items():
        kept = {t: p for t, p in opened.parts.items() if t in refresh.with_sources([name])}
        star = snapshot_star(spark, replace(opened, parts=kept))
        stored = opened.read(spark, name)
        assert rows(build(star).select(stored.columns)) == rows(stored), name
