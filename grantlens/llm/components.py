"""Connected components by alternating large and small stars, kept in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import stored


ONE_TASK = 200_000  # links that one task may hold: a few megabytes


def _linked_to_least(edges: DataFrame, keep, single: bool) -> DataFrame:
    """For every node the least of itself and its neighbours, linked with the neighbours ``keep`` selects.

    The least is found by an aggregate, which Spark combines before it shuffles; the join back is
    one that Spark splits where a node has very many neighbours.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    links = (
        edges.join(least, "u").where(keep)
        .select(F.col("v").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b")))
        .where("a <> b")
    )
    return (links.coalesce(1) if single else links).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of the nodes in ``links``, which has the columns a and b.

    Each turn halves the length of the longest chain at least; the edges are written after each turn.
    Up to ONE_TASK links are worked on by one task, without shuffles; more are spread as usual.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state, single = None, edges.count() <= ONE_TASK
    while True:
        ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                 F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
        both = (edges.coalesce(1) if single else edges).select(ends.alias("end")).select("end.*")
        large = _linked_to_least(both, F.col("v") > F.col("u"), single)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = stored(_linked_to_least(down, F.lit(True), single), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            # only stars are left
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = now
