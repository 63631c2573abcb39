"""Mix sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document draws an exponential key, scaled by its quality weight; within its source the
documents with the smallest keys come first. A source gets whole epochs as far as its target
allows, and the rest of the target from the front of that order. Only Spark expressions are used.

A source of any size is cut into slices of the key's range: sizes are summed per slice, summed
again along the slices, and rows are ordered only within a slice. No task sees a whole source.

Nulls: a null text has no words; a null source is a source of its own, the last one. A null
``doc_id`` draws like any other value. Repeated rows draw the same key and take their turns one
after the other. An empty table gives an empty result. Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import WORD, stored, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SLICES = 4096


def quality_weight(size: Column, n_chars: Column) -> Column:
    """1 for texts whose words have a plausible mean length, a quarter for others."""
    mean_length = n_chars / F.greatest(size, F.lit(1))
    return F.when(mean_length.between(3, 12), 1.0).otherwise(0.25)


def exponential_key(seed: str, weight: Column) -> Column:
    """-ln(u) / weight, where u depends on the seed, the id and the text only."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               text_or_empty()))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def with_draws(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The columns of ``docs`` and the ones this module adds: mix_size, mix_key, mix_source."""
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.withColumns({
        "mix_size": size,
        "mix_key": exponential_key(seed, quality_weight(size, F.length(text_or_empty()))),
        # never null, and different for a null source and an empty one
        "mix_source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
    })


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """mix_source, source_size, target: words wanted of each source.

    Targets are the least of a source's cap and its weight times one common level. Sources reach
    their caps in the order of cap / weight; the level that uses up the budget is the largest of
    those found by taking ever more of them as full. One row per source is all that is ordered.
    """
    everyone = Window.partitionBy()
    by_name = Window.orderBy(F.col("mix_source") == "", "mix_source")
    ranked = (
        sized.groupBy("mix_source")
        .agg(F.sum("mix_size").alias("source_size"))
        .withColumn("turn", F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("turn") + 1))
        .withColumn("most", F.lit(cap) * F.col("source_size"))
    )
    fill = Window.orderBy(F.col("most") / F.col("weight"), "mix_source")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.lit(share) * F.sum("source_size").over(everyone)
    left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = (budget - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / left
    return ranked.withColumn("level", level).select(
        "mix_source", "source_size",
        F.least("most", F.max("level").over(everyone) * F.col("weight")).alias("target"),
    )


def _slice() -> Column:
    """Keys run from 0 without bound; key / (1 + key) spreads them over the slices."""
    return F.floor(F.col("mix_key") / (1 + F.col("mix_key")) * SLICES).cast("int")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = "mix",
        whole: bool = False) -> DataFrame:
    """doc_id, mix_source, mix_key, size, source_size, target, epochs, taken for every row of ``docs``.

    ``taken`` counts the words the mix takes of a document: its size for each epoch, and once more
    if it lies in the front of the order. The document at the edge is taken in part, so that every
    source meets its target to the word; with ``whole`` it is taken if more than half of it fits.
    """
    drawn = stored(
        with_draws(docs.select("doc_id", "text", "source"), seed)
        .select("doc_id", "mix_source", "mix_size", "mix_key")
        .withColumn("mix_slice", _slice()),
        "draws",
    )
    targets = source_targets(drawn, weights, share, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    along = Window.partitionBy("mix_source").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        drawn.groupBy("mix_source", "mix_slice").agg(F.sum("mix_size").alias("slice_size"))
        .withColumn("slice_start", F.coalesce(F.sum("slice_size").over(along), F.lit(0)))
        .join(targets, "mix_source")
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
        .drop("slice_size")
    )
    within = Window.partitionBy("mix_source", "mix_slice").orderBy("mix_key", "doc_id", "mix_size")
    upto = F.sum("mix_size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    start = F.col("slice_start") + upto - F.col("mix_size")
    room = F.greatest(F.lit(0), F.least("mix_size", F.col("rest") - start))
    if whole:
        room = F.when(2 * room > F.col("mix_size"), F.col("mix_size")).otherwise(0)
    return drawn.join(slices, ["mix_source", "mix_slice"]).select(
        "doc_id", "mix_source", "mix_key", F.col("mix_size").alias("size"), "source_size", "target",
        "epochs", (F.col("epochs") * F.col("mix_size") + room).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept.

    The edge of the order is one key per source, so the texts are filtered where they lie: they
    are neither joined by id nor shuffled. Rows without words are taken once per epoch.
    """
    result = mix(docs, whole=True, **options)
    edges = result.groupBy("mix_source").agg(
        F.first("epochs").alias("mix_epochs"),
        F.max(F.when(F.col("taken") > F.col("epochs") * F.col("size"), F.col("mix_key"))).alias("mix_edge"),
    )
    copies = F.col("mix_epochs") + F.coalesce(F.col("mix_key") <= F.col("mix_edge"), F.lit(False)).cast("long")
    whole = docs.select(F.struct(*docs.columns).alias("mix_row"), "doc_id", "text", "source")
    return (
        with_draws(whole, options.get("seed", "mix")).join(edges, "mix_source")
        .withColumn("mix_copies", copies).where("mix_copies > 0")
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
        .select("mix_row.*")
    )
