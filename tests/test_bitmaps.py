"""Counts from bitmaps against the exact route over the facts, and gap-free numbers."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from grantlens.operators.dense import dense_numbers
from grantlens.plans import filtered
from grantlens.plans.bitmaps import Bitmaps, bitmaps, write_bitmaps
from grantlens.plans.filtered import Filters
from star_rows import rows

CHOICES = [
    Filters(*window, countries=places, sections=sections, classes=classes)
    for window, places, sections, classes in product(
        [(2000, 2004), (2001, 2001), (1990, 1991)], [(), ("US",), ("US", "DE"), ("XX",)], [(), ("H", "F")], [(), ("H02", "F02")])
]


@pytest.fixture(scope="module")
def stored(spark, small_star, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bitmaps"))
    write_bitmaps(small_star, folder)
    return Bitmaps(spark, folder)


def test_counts_equal_the_exact_route(small_star, stored):
    for f in CHOICES[::3]:
        assert rows(stored.yearly(f)) == rows(filtered.yearly(small_star, f)), f
        assert rows(stored.countries(f)) == rows(filtered.countries(small_star, f)), f
        if not f.by_class:
            assert rows(stored.overview(f)) == rows(filtered.overview(small_star, f)), f


def test_sections_count_a_patent_once(small_star, stored):
    assert rows(stored.sections(Filters(2000, 2004))) == [("F", 2), ("H", 2), ("Z", 1)]
    assert rows(stored.sections(Filters(2000, 2004, countries=("DE",)))) == [("F", 1), ("H", 1)]


def test_classes_have_no_overview(stored):
    with pytest.raises(ValueError):
        stored.overview(Filters(2000, 2004, sections=("H",)))


def test_numbers_have_no_gaps(spark):
    ids = spark.range(5000).select(F.concat(F.lit("x"), "id").alias("key"), (F.col("id") % 7).alias("year"))
    found = dense_numbers(ids.repartition(5), "key", by="year", slice_rows=100)
    per_year = found.groupBy("year").agg(F.count("number").alias("n"), F.count_distinct("number").alias("d"), F.max("number").alias("m"))
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in per_year.collect())
    assert rows(found) == rows(dense_numbers(ids.repartition(3), "key", by="year", slice_rows=100))
    assert dense_numbers(ids.limit(0), "key").count() == 0


def test_numbers_beyond_one_bucket(spark):
    many = spark.range(100_000).select((F.col("id") % 70_000).alias("number"))
    found = bitmaps(many, []).agg(F.sum(F.bitmap_count("bits")), F.count("bucket")).first()
    assert tuple(found) == (70_000, 3)
