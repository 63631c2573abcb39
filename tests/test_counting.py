"""Distinct rows and patents by label: one shuffle, one narrow sort, no hash table of all rows."""

from pyspark.sql import functions as F

from grantlens.operators.copies import distinct_by
from grantlens.operators.counting import count_ids, count_patents, count_patents_by_label, smallest_text
from grantlens.plans.bitmaps import bitmaps
from star_rows import rows

PAIRS = [("p1", "a", 2000), ("p1", "b", 2000), ("p1", "a", 2000), ("p2", "a", 2001), ("p2", "c", 2001), ("p3", "d", 2001),
         ("p3", "e", 2001), (None, "a", 2001)]
PEOPLE = [("a", "Ann", "US"), ("b", "Ann", "US"), ("c", "Ann", None), ("d", None, None), ("e", None, None), ("z", "Zed", "US")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_rows_by_a_sort(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", None), (1, None, None), (1, None, None), (2, "x", 1), (None, None, None), (None, None, None)],
                               "id int, a string, b int")
    assert rows(distinct_by(df, "id")) == rows(df.distinct())
    assert "HashAggregate" not in _plan(distinct_by(df, "id")) and _plan(distinct_by(df, "id")).count("Exchange") == 1


def test_patents_of_entities_that_share_a_label(spark):
    pairs = spark.createDataFrame(PAIRS, "patent_id string, inventor_id string, year int")
    people = spark.createDataFrame(PEOPLE, "inventor_id string, inventor string, country string")
    got = count_patents_by_label(pairs, people, "inventor_id", ["inventor", "country"])
    want = count_ids(pairs.join(people, "inventor_id"), ["inventor", "country", "year"], "patent_id", "patents")
    assert rows(got.select(want.columns)) == rows(want.filter("patents > 0"))
    assert rows(count_patents(pairs, ["year"])) == [(2000, 1), (2001, 2)]


def test_numbers_are_shuffled_not_bitmaps(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("number"))
    made = bitmaps(df, ["k"])
    plan = _plan(made)
    assert plan.index("SortAggregate") < plan.index("Exchange") and "SortAggregate" not in plan[plan.index("Exchange"):]
    assert made.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 100_000


def test_smallest_texts_are_found_among_different_rows(spark):
    """Spark leaves a distinct step below a minimum out, and then sorts all rows."""
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", None), ("b", None), ("c", "")], "id string, t string")
    plan = _plan(smallest_text(df, "id", "t"))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert sorted(map(tuple, smallest_text(df, "id", "t").collect())) == [("a", "x"), ("b", None), ("c", "")]
