"""Results that several steps read."""

import time

from pyspark.sql import functions as F

from grantlens.llm import common


def _shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(k).getName() for k in range(files.size()))
    return {name for name in found if name.startswith("shuffle_")}


def test_a_stored_result_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(common._CLEANUP, None)
    before = _shuffled(spark)
    df = spark.range(2000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    found = common.stored(df, "counted")
    until = time.time() + 20
    while (left := _shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert found.count() == 7 and spark.conf.get(common._CLEANUP, None) == setting
