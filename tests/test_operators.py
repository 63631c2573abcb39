import pytest
from pyspark.sql import Window, functions as F

from star_rows import rows
from grantlens.operators import (
    counting,
    growing,
    numbering,
    quality,
    ranking,
    reshaping,
    sampling,
    shares,
)
from grantlens.operators.broadcasting import MAX_BROADCAST_ROWS, broadcast_if_bounded


@pytest.fixture(scope="module")
def skewed(spark):
    """30 000 rows; one key holds a third of them."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))
    )
    return spark.range(0, 30000, 1, 6).select(
        key.alias("key"), F.md5(F.col("id").cast("string")).alias("value"), "id"
    )


def test_top_per_group_below_and_above_the_pruning_threshold(skewed):
    window = Window.partitionBy("key").orderBy("value")
    numbered = skewed.withColumn("n", F.row_number().over(window))
    for k in (1, 3, 1500):
        want = numbered.filter(F.col("n") <= k).drop("n")
        got = ranking.top_per_group(skewed, ["key"], [F.asc("value")], k)
        assert got.columns == skewed.columns
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_top_per_group_is_pruned_before_the_shuffle(skewed):
    for k in (1, 1000):
        plan = ranking.top_per_group(skewed, ["key"], [F.asc("value")], k)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "row_number(), %d, Partial" % k in text


def test_ranked_within_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", 1)], "k string, n int")
    got = ranking.ranked_within(df, ["k"], [F.desc("n")], 2, "r")
    assert rows(got) == [("a", 5, 1), ("a", 5, 1)]


def test_pages(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, n int")
    order = ranking.sort_choice("count_desc", "n", "id", ["id"])
    pages = [ranking.page(df, order, 4, o).collect() for o in (0, 4, 8, 12)]
    assert [len(p) for p in pages] == [4, 4, 2, 0]
    assert sorted(r.id for p in pages for r in p) == list(range(10))
    assert ranking.page_count(0, 50) == 1 and ranking.page_count(101, 50) == 3
    assert ranking.page_offset(101, 50, 9) == 100 and ranking.page_offset(0, 50, 3) == 0
    with pytest.raises(ValueError):
        ranking.sort_choice("other", "n", "id", [])


def test_counts_on_a_hot_key(skewed):
    got = counting.count_ids(skewed, ["key"], "id", "n")
    want = skewed.groupBy("key").agg(F.count("id").alias("n"))
    assert rows(got) == rows(want)


def test_most_frequent_breaks_ties_by_value(spark):
    df = spark.createDataFrame(
        [("a", "z"), ("a", "z"), ("a", "b"), ("a", "b"), ("b", "q")], "k string, v string"
    )
    assert rows(counting.most_frequent(df, "k", "v")) == [("a", "b"), ("b", "q")]


def test_number_within_equals_row_number(spark, skewed):
    """A parent with a third of all rows, one without a key, ties up to full copies, nulls in the order."""
    odd = spark.sql("SELECT CAST(NULL AS STRING) AS key, IF(id % 5 = 0, NULL, CAST(id % 9 AS STRING)) AS value, id % 40 AS id FROM range(400)")
    df = skewed.unionByName(odd)
    window = Window.partitionBy("key").orderBy(F.asc_nulls_last("value"), F.asc_nulls_last("id"))
    want = df.withColumn("n", F.row_number().over(window))
    for huge, slices in ((1_000_000, 256), (300, 7), (300, 200)):
        got = numbering.number_within(df, "key", ["value", "id"], "n", huge, slices)
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == df.count()


def test_a_huge_parent_is_numbered_in_ranges(skewed):
    plan = numbering.number_within(skewed, "key", ["id"], "n", 1000, 16)._jdf.queryExecution().optimizedPlan().toString()
    spans = [r for r in plan.split("\n") if "row_number() windowspecdefinition(key#" in r]
    assert spans and all("_slice#" in r.split("windowspecdefinition(", 1)[1].split("ASC")[0] for r in spans)


def test_sample_is_fixed_by_the_key(skewed):
    quota = skewed.select("key").distinct().withColumn("quota", F.lit(7))
    once = sampling.stratified_sample(skewed, quota, "key", "id", 7)
    again = sampling.stratified_sample(skewed.repartition(13), quota, "key", "id", 7)
    assert once.exceptAll(again.select(once.columns)).count() == 0
    assert once.groupBy("key").count().agg(F.max("count")).first()[0] == 7


def test_quota_rounds_half_to_even(spark):
    volumes = spark.createDataFrame([(1, 400), (2, 1), (3, 397), (4, 393)], "y int, n long")
    got = dict(rows(sampling.proportional_quota(volumes, "y", "n", 200, 25)))
    assert got == {1: 200, 2: 25, 3: round(397 / 400 * 200), 4: round(393 / 400 * 200)}


def test_two_sided_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, 2000), ("a", 2, 2001), ("a", 3, 2005), ("b", 3, 2005)],
        "k string, patent_id int, year int",
    )
    got = growing.two_sided_counts(df, "k", F.col("year") <= 2001, ("x", "y"))
    assert rows(got) == [("a", 2, 1), ("b", 0, 1)]


def test_endpoints_and_trend(spark):
    yearly = spark.createDataFrame([("a", 2000, 2), ("a", 2003, 16), ("b", 2001, 1)], "k string, year int, patents long")
    assert rows(growing.endpoints(yearly, ["k"])) == [
        ("a", 2000, 2003, 2, 16, 18), ("b", 2001, 2001, 1, 1, 1)
    ]
    rates = growing.compound_growth_table(yearly, ["k"], 1, 1).select("k", "cagr")
    assert rows(rates) == [("a", 1.0)]
    got = growing.trend(yearly.filter("k = 'a'").select("year", "patents")).orderBy("year").collect()
    assert [tuple(r) for r in got] == [(2000, 2, None, 2), (2003, 16, 7.0, 18)]


def test_shares_and_concentration(spark):
    counts = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "k string, n long")
    assert rows(shares.with_share(counts, "n").select("k", "share")) == [("a", 0.5), ("b", 0.3), ("c", 0.2)]
    got = shares.concentration(counts, "k", "n", (1, 2)).first()
    assert (got.hhi, got["keys"], got.top1_share, got.top2_share) == (3800.0, 3, 0.5, 0.8)
    empty = shares.concentration(counts.filter("n < 0"), "k", "n", (1,)).first()
    assert empty.hhi is None and empty["keys"] == 0


def test_pivot_and_unpivot(spark):
    cells = spark.createDataFrame([("x", "A", 1), ("y", "B", 2)], "r string, c string, v long")
    wide = reshaping.pivot_counts(cells, "r", "c", "v", ["A", "B", "C"])
    assert rows(wide) == [("x", 1, 0, 0), ("y", 0, 2, 0)]
    long = reshaping.unpivot(wide, ["r"], ["A", "B"], "c", "v")
    assert rows(long) == [("x", "A", 1), ("x", "B", 0), ("y", "A", 0), ("y", "B", 2)]
    assert reshaping.slim(cells, {"v": "value", "r": "row"}).columns == ["value", "row"]


def test_quality_checks(spark):
    child = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(quality.orphans(child, parent, "k")) == [("z",)]
    assert rows(quality.duplicate_keys(parent, ["k"])) == [("a", 2)]
    assert quality.missing_columns(child, ["k", "m"]) == ["m"]
    assert quality.is_empty(child.filter("false")) and not quality.is_empty(child)


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(10)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_bounded(df, 10))
    assert not hinted(broadcast_if_bounded(df, MAX_BROADCAST_ROWS + 1))


def test_a_hot_join_key_is_split_at_run_time(spark):
    """With the thresholds lowered to test size, the join runs with skew handling."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 700)
        links = spark.range(0, 60000, 1, 8).select(F.col("id").alias("patent_id"), key.alias("inventor_id"))
        people = spark.range(700).select(
            F.col("id").alias("inventor_id"), (F.col("id") % 5).cast("string").alias("country")
        )
        joined = links.join(people, "inventor_id")
        counts = counting.count_ids(joined, ["country"], "patent_id", "n")
        assert sum(r.n for r in counts.collect()) == 60000
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
