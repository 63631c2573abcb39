"""Build a stored star, and bring it up to date when more raw rows arrive.

Raw rows are kept as they were loaded. A refresh finds what the new rows touch: entities that they name or whose
location they describe, and patents that they name or that belong to an entity whose stored row changed. Only these are
cleaned again, from all their raw rows. Facts and patents are stored by year, entities in buckets of their id's
hash; a part is written anew if a touched row was or is in it, from its other rows and the new ones. Yearly
summaries are written anew for those years. A load of more than half as many rows of patents as were loaded before touches
nearly everything: all tables are then made anew, and nothing is looked up first. Where fewer rows touch more than half as
many patents as are stored, all facts are written anew. The result is the star a full build would make.

The first load may name the tables that are wanted. They, and what they are made from, are then all that this load and
later ones keep and bring up to date: patents alone need no inventors, classes need no links.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantlens.functions.text import key_present, trimmed
from grantlens.plans import clean, summaries
from grantlens.schemas import CLEAN, RAW, conform
from grantlens.sources import snapshots
from grantlens.sources.snapshots import Draft, Snapshot
from grantlens.sources.warehouse import CLEAN_TABLES, snapshot_star
from grantlens.star import Star

BUCKETS = 32
MANY = 0.5  # new rows of patents, as a part of the earlier ones, and touched ids, as a part of the stored patents, above which all is written anew

# Summaries with one row per something and year, which a refresh replaces by year.
YEARLY = ("mv_yearly", "mv_country_yearly", "mv_section_yearly", "mv_company_yearly", "mv_inventor_yearly")

_FACTS = ("patents", "links", "cpc")

# The raw tables each clean table is made from, and the clean ones it needs besides.
_RAW_OF = {
    "patents": ("patents",), "inventors": ("inventors", "locations"), "companies": ("assignees",),
    "links": ("inventors", "assignees"), "cpc": ("cpc",),
}
_NEEDS = {"links": ("patents", "inventors", "companies"), "cpc": ("patents",)}


def with_sources(tables: Iterable[str]) -> set[str]:
    """These clean tables and summaries, and the clean tables they are made from."""
    found = set(tables)
    if unknown := found - {*CLEAN_TABLES, *summaries.SUMMARIES}:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    for needs in (summaries.MADE_FROM, _NEEDS):
        found |= {source for name in found for source in needs.get(name, ())}
    return found


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _as_raw(df: DataFrame, name: str) -> DataFrame:
    """All columns of the raw layout; those the rows lack are NULL."""
    return df.select([
        (F.col(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string")).alias(f.name)
        for f in RAW[name]
    ])


def _ids(df: DataFrame, column: str, key: str) -> DataFrame:
    """The different ids in a raw column, in their clean form."""
    return df.filter(key_present(F.col(column))).select(trimmed(F.col(column)).alias(key)).distinct()


def _of(df: DataFrame, column: str, ids: DataFrame | None) -> DataFrame:
    """Raw rows whose column holds one of ``ids`` (all rows without ids)."""
    if ids is None:
        return df
    return df.join(ids.toDF("_touched"), trimmed(F.col(column)) == F.col("_touched"), "left_semi")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _stored_form(df: DataFrame, name: str) -> DataFrame:
    """Columns of a stored table: the clean ones, then flags and the column it is stored by."""
    extra = [c for c in df.columns if c not in CLEAN[name].names]
    clean_columns = conform(df, CLEAN[name]).columns
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN[name] if f.name != "year"]
                     + [F.col(c) for c in extra if c not in clean_columns and c != "year"]
                     + ([F.col("year").cast("int").alias("year")] if "year" in df.columns else []))


class _Refresh:
    def __init__(self, spark: SparkSession, draft: Draft, fresh: Mapping[str, DataFrame], settings: dict, wanted: set[str]):
        self.spark, self.draft, self.settings = spark, draft, settings
        self.first = not draft.parts
        wanted = wanted if self.first else set(draft.parts)
        self.tables = [name for name in CLEAN_TABLES if name in wanted]
        self.summaries = [name for name in summaries.SUMMARIES if name in wanted]
        kept = [name for name in RAW if any(name in _RAW_OF[table] for table in self.tables)]
        told = f"raw_{kept[0]}"  # patents, unless only entities are kept
        loaded = [] if self.first else draft.parts[told]
        new = {name: draft.append(_as_raw(fresh[name], name), f"raw_{name}") for name in kept}
        self.new = {name: draft.read(spark, f"raw_{name}", parts) for name, parts in new.items()}
        self.raw = {name: draft.read(spark, f"raw_{name}") for name in kept}
        # rows are counted in the footers of files; a load of many is not compared with what is stored
        self.anew = self.first or draft.written[told] > MANY * draft.read(spark, told, loaded).count()

    def run(self) -> None:
        people = firms = None
        if "inventors" in self.tables:
            people = self._entities("inventors", "inventor_id", self._touched_people())
        if "companies" in self.tables:
            firms = self._entities("companies", "company_id", self._touched_firms())
        if "patents" not in self.tables:
            return
        ids = None if self.anew else self._few(self.draft.stage(self._touched_patents(people, firms), "patent_ids"))
        years = self._facts(ids)
        if self.summaries:
            self._summaries(years)

    # -- what the new rows touch ----------------------------------------------------------

    def _touched_people(self) -> DataFrame | None:
        if self.anew:
            return None
        named = _ids(self.new["inventors"], "inventor_id", "inventor_id")
        places = _ids(self.new["locations"], "location_id", "location_id")
        living = _ids(_of(self.raw["inventors"], "location_id", places), "inventor_id", "inventor_id")
        return named.unionByName(living).distinct()

    def _touched_firms(self) -> DataFrame | None:
        return None if self.anew else _ids(self.new["assignees"], "assignee_id", "company_id")

    def _touched_patents(self, people: DataFrame | None, firms: DataFrame | None) -> DataFrame:
        rows = [self.new[name] for table in _FACTS if table in self.tables for name in _RAW_OF[table]]
        if "links" in self.tables:
            rows.append(_of(self.raw["inventors"], "inventor_id", people))
            rows.append(_of(self.raw["assignees"], "assignee_id", firms))
        ids = [df.filter(F.col("patent_id").isNotNull()).select(trimmed(F.col("patent_id")).alias("patent_id")) for df in rows]
        return _union(ids).distinct()

    def _few(self, ids: DataFrame) -> DataFrame | None:
        """``ids``, or nothing where they are so many that cleaning all patents again is less work than picking them out."""
        return ids if ids.count() <= MANY * self.draft.read(self.spark, "patents").count() else None

    # -- tables ---------------------------------------------------------------------------

    def _cleaned(self, table: str, ids: DataFrame | None) -> DataFrame:
        if table == "companies":
            return clean.clean_companies(_of(self.raw["assignees"], "assignee_id", ids))
        return clean.clean_inventors(
            _of(self.raw["inventors"], "inventor_id", ids), self.raw["locations"], self.settings["prefer_named"])

    def _entities(self, table: str, key: str, ids: DataFrame | None) -> DataFrame | None:
        """Bring an entity table up to date; returns the ids whose stored row is new or another one."""
        rows = _bucketed(conform(self._cleaned(table, ids), CLEAN[table]), key)
        if ids is None:
            self.draft.replace(rows, table, "bucket")
            return None
        rows = self.draft.stage(rows, f"{table}_rows")
        stored = self.draft.read(self.spark, table)
        others = [c for c in CLEAN[table].names if c != key]
        before = stored.select(key, F.struct(*others).alias("was"))
        changed = self.draft.stage(
            rows.join(before, key, "left").filter(~F.col("was").eqNullSafe(F.struct(*others))).select(key, "bucket"),
            f"{table}_changed",
        )
        buckets = [r[0] for r in changed.select("bucket").distinct().collect()]  # at most BUCKETS
        touched = self.draft.read(self.spark, table, self.draft.of_values(table, "bucket", buckets))
        inside = rows.filter(F.col("bucket").isin(buckets))
        self.draft.replace_parts(touched.join(inside, key, "left_anti").unionByName(inside), table, "bucket", buckets)
        return changed.select(key)

    def _facts(self, ids: DataFrame | None) -> list | None:
        """Bring patents, links and classes up to date; returns the years written, nothing where all were."""
        low, high = self.settings["years"]
        patents = _stored_form(clean.clean_patents(_of(self.raw["patents"], "patent_id", ids), low, high), "patents")
        if ids is None:
            self.draft.replace(patents, "patents", "year")
            patents = self.draft.read(self.spark, "patents")
        else:
            patents = self.draft.stage(patents, "patents_rows")
        rows = {"patents": patents}
        if "links" in self.tables:
            inventors = self.draft.read(self.spark, "inventors").select(CLEAN["inventors"].names)
            companies = self.draft.read(self.spark, "companies").select(CLEAN["companies"].names)
            rows["links"] = _stored_form(clean.marked_links(
                _of(self.raw["inventors"], "patent_id", ids), _of(self.raw["assignees"], "patent_id", ids), patents, companies, inventors,
            ), "links")
        if "cpc" in self.tables:
            rows["cpc"] = _stored_form(clean.marked_cpc(_of(self.raw["cpc"], "patent_id", ids), patents), "cpc")
        if ids is None:
            for table in rows.keys() - {"patents"}:
                self.draft.replace(rows[table], table, "year")
            return None
        seen = self.draft.read(self.spark, "patents").join(ids, "patent_id", "left_semi").select("year")
        years = [r[0] for r in seen.unionByName(patents.select("year")).distinct().collect()]  # a few dozen
        for table in rows:
            stored = self.draft.read(self.spark, table, self.draft.of_values(table, "year", years))
            kept = stored.join(ids, "patent_id", "left_anti")
            self.draft.replace_parts(kept.unionByName(rows[table]), table, "year", years)
        return years

    def _summaries(self, years: list | None) -> None:
        star = snapshot_star(self.spark, self.draft)
        known = [y for y in years or [] if y is not None]
        touched = star if years is None else _in_years(star, F.col("year").isin(known))
        for name in self.summaries:
            build = summaries.SUMMARIES[name]
            if name not in YEARLY:
                self.draft.replace(build(star), name)
            elif years is None:
                self.draft.replace(build(star), name, "year")
            else:
                self.draft.replace_parts(build(touched), name, "year", known)


def _in_years(star: Star, chosen: Column) -> Star:
    """The patents of some years with their facts; flags stay true, since they speak of one patent each."""
    stored = {"links": star.dated_links, "cpc": star.dated_cpc}
    dated = {name: None if df is None else df.filter(chosen) for name, df in stored.items()}
    facts = {name: None if df is None else df.select(CLEAN[name].names) for name, df in dated.items()}
    return Star(
        patents=star.patents.filter(chosen), inventors=star.inventors, companies=star.companies,
        **facts, dated_links=dated["links"], dated_cpc=dated["cpc"],
    ).as_opened()


def _settings(min_year: int, max_year: int, prefer_named: bool) -> dict:
    return {"years": (min_year, max_year), "prefer_named": prefer_named}


def _asked(tables: Iterable[str] | None, summarised: bool) -> set[str]:
    return with_sources((*CLEAN_TABLES, *(summaries.SUMMARIES if summarised else ())) if tables is None else tables)


def build(
    raw: Mapping[str, DataFrame], folder: str, min_year: int = 1976, max_year: int = 2025, prefer_named: bool = False,
    summarised: bool = True, tables: Iterable[str] | None = None,
) -> Snapshot:
    """A snapshot of the raw tables alone, whatever the folder held before; with or without the summary tables, or
    with the clean tables and summaries named by ``tables`` and what those are made from."""
    spark = raw["patents"].sparkSession
    draft = snapshots.draft(spark, folder)
    _Refresh(spark, draft, raw, _settings(min_year, max_year, prefer_named), _asked(tables, summarised)).run()
    return draft.commit(spark)


def load(
    raw: Mapping[str, DataFrame], folder: str, min_year: int = 1976, max_year: int = 2025, prefer_named: bool = False,
    summarised: bool = True, tables: Iterable[str] | None = None,
) -> Snapshot:
    """A snapshot of the raw rows loaded so far and these; the first load is a build.

    Year bounds and naming must stay what they were in the first load; it decides which tables there are.
    """
    spark = raw["patents"].sparkSession
    before = snapshots.snapshot(spark, folder)
    if before is None:
        return build(raw, folder, min_year, max_year, prefer_named, summarised, tables)
    draft = before.next()
    _Refresh(spark, draft, raw, _settings(min_year, max_year, prefer_named), _asked(tables, summarised)).run()
    return draft.commit(spark)


def build_warehouse(
    raw: Mapping[str, DataFrame], folder: str, min_year: int = 1976, max_year: int = 2025, prefer_named: bool = False,
) -> dict[str, int]:
    """Build a snapshot of the clean tables; returns the rows written to each."""
    written = build(raw, folder, min_year, max_year, prefer_named, summarised=False).written
    return {name: written.get(name, 0) for name in ("patents", "inventors", "companies", "links", "cpc")}
