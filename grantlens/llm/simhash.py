"""SimHash fingerprints of 128 bits, and the search for near ones in permuted block tables.

The terms of a text are its pairs of neighbouring words (the last word also alone). Each occurrence
of a term votes on every bit by its hash; a bit is set if more than half of the votes want it, so a
term weighs as much as it occurs. All of it is Spark expressions: votes on bits k and k + 32 are
counted in the two halves of one sum.

``edited`` texts mix each document with the next one by ``doc_id``. Documents are cut into slices of the
id's range, from approximate quantiles; the next text is found within a slice, and the first text of each slice
is handed to the slice before. No task sees more than a slice.

A null text is an empty one; texts without words have the fingerprint 0. Null ids come last, in a
slice of their own. Equal ids follow each other by text. A single document is its own next one. An
empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import WORD, stored, text_or_empty

SLICE_ROWS = 5000
QUANTILES = 64
BITS = 128
BLOCKS = 6

_PAIRED = 0x0000000100000001  # bits k and k + 32 of a hash, as two counters of one number


def terms(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words, and of the last word."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.zip_with(words, following, lambda a, b: F.xxhash64(a, b))


def vote_sums(hashed: Column) -> list[Column]:
    """Sums v0 to v63 over the rows of a group: counters of bits k and k + 32 of two hashes."""
    second = F.when(hashed.isNotNull(), F.xxhash64(hashed))
    return [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_PAIRED))).alias(f"v{32 * j + k}")
        for j, h in enumerate((hashed, second))
        for k in range(32)
    ]


def fingerprint_half(half: int, count: Column) -> Column:
    """64 bits of the fingerprint; a bit is set if more than half of ``count`` votes want it."""
    bits = []
    for k in range(32):
        sums = F.coalesce(F.col(f"v{32 * half + k}"), F.lit(0))
        low, high = sums.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(sums, 32)
        bits += [F.shiftleft((2 * low > count).cast("long"), k), F.shiftleft((2 * high > count).cast("long"), k + 32)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _hex(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The share of equal bits of two fingerprints, each given as the names of two columns."""
    unlike = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0))
    return 1 - unlike / F.lit(float(BITS))


def _tree(value: Column, cuts: list[int], first: int = 0) -> Column:
    """How many of the ascending ``cuts`` do not exceed ``value``, by nested comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value < cuts[middle], _tree(value, cuts[:middle], first)).otherwise(
        _tree(value, cuts[middle + 1:], first + middle + 1)
    )


def slice_of(docs: DataFrame, rows: int = SLICE_ROWS) -> Column:
    """A number that ascends with ``doc_id``; about ``rows`` documents have the same.

    Quantiles of the ids (one scan of that column) give ranges of like numbers of rows; each is cut
    evenly. Null ids have the highest number.
    """
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    n, low, high, cuts = docs.agg(
        F.count("doc_id"), F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10_000)
    ).first()
    if not n:
        return F.lit(0)
    cuts = sorted(set(cuts) - {low})
    edges = [low, *cuts, high + 1]
    parts = max(1, -(-n // (rows * (len(edges) - 1))))
    place = _tree(F.col("doc_id"), cuts)
    lows = F.array(*(F.lit(float(x)) for x in edges[:-1]))
    widths = F.array(*(F.lit(float(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)))
    inside = (F.col("doc_id").cast("double") - F.element_at(lows, place + 1)) / F.element_at(widths, place + 1)
    part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(inside * parts)))
    return F.coalesce(place.cast("long") * parts + part, F.lit(parts * (len(edges) - 1)).cast("long"))


def with_next(docs: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, text, slice, turn, next_text, next_slice, next_turn: the texts in their order."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sliced = source.withColumn("slice", slice_of(source, rows))
    order = Window.partitionBy("slice").orderBy("doc_id", "text")
    firsts = sliced.groupBy("slice").agg(F.min(F.struct("doc_id", "text"))["text"].alias("first_text"))
    along = Window.orderBy("slice")  # one row per slice, without its text
    around = Window.partitionBy()
    numbers = sliced.select("slice").distinct().withColumn(
        "next_slice", F.coalesce(F.lead("slice").over(along), F.min("slice").over(around))
    )
    handed = numbers.join(firsts.withColumnRenamed("slice", "next_slice"), "next_slice")
    return (
        sliced.withColumn("turn", F.row_number().over(order))
        .withColumn("within", F.lead("text").over(order))
        .join(handed, "slice")
        .select(
            "doc_id", "text", "slice", "turn",
            F.coalesce("within", "first_text").alias("next_text"),
            F.when(F.col("within").isNull(), F.col("next_slice")).otherwise(F.col("slice")).alias("next_slice"),
            F.when(F.col("within").isNull(), 1).otherwise(F.col("turn") + 1).alias("next_turn"),
        )
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many of the next."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _words_of(digest: Column) -> list[Column]:
    """A digest of 64 hexadecimal digits as four numbers, which sums and maxima carry cheaply."""
    return [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, -10).cast("long") for k in range(4)]


def fingerprints(docs: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    mixed = with_next(docs, rows).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    carried = ["doc_id", "n_chars", "next_slice", "next_turn", "d0", "d1", "d2", "d3"]
    ready = mixed.withColumn("n_chars", F.length("text")).withColumn("digest", F.sha2("edited", 256)).select(
        "slice", "turn", *carried[:4], *(w.alias(f"d{k}") for k, w in enumerate(_words_of(F.col("digest")))),
        F.posexplode(F.array("text", "edited")).alias("which", "body"),
    )
    votes = (
        ready.select("slice", "turn", "which", *carried, F.explode_outer(terms(F.col("body"))).alias("term"))
        .groupBy("slice", "turn", "which")
        .agg(F.count("term").alias("votes"), *vote_sums(F.col("term")), *(F.max(c).alias(c) for c in carried))
        .select("slice", "turn", "which", *carried,
                fingerprint_half(0, F.col("votes")).alias("f0"), fingerprint_half(1, F.col("votes")).alias("f1"))
    )
    pairs = stored(votes, "fingerprints")
    own = pairs.where("which = 0")
    other = pairs.where("which = 1").select("slice", "turn", F.col("f0").alias("e0"), F.col("f1").alias("e1"))
    following = own.select(F.col("slice").alias("next_slice"), F.col("turn").alias("next_turn"),
                           F.col("f0").alias("g0"), F.col("f1").alias("g1"))
    return own.join(other, ["slice", "turn"]).join(following, ["next_slice", "next_turn"]).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.concat(*(_hex(F.col(f"d{k}")) for k in range(4))).alias("edited_sha256"),
        F.concat(_hex(F.col("f0")), _hex(F.col("f1"))).alias("fingerprint"),
        F.concat(_hex(F.col("e0")), _hex(F.col("e1"))).alias("edited_fingerprint"),
        likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"),
        likeness(("f0", "f1"), ("g0", "g1")).alias("near_next"),
    )


def near_pairs(prints: DataFrame, radius: int, blocks: int = BLOCKS) -> DataFrame:
    """a, b, distance: all pairs a < b of different fingerprints within ``radius`` bits.

    ``prints`` has the column fingerprint (32 hexadecimal digits). The bits are cut into ``blocks``;
    two fingerprints within the radius agree on all but ``radius`` of them. There is a table for every choice of the
    others, keyed by those blocks brought to the front, and only rows of one key are compared; a pair is
    taken from the first table it is found in. Equal fingerprints are one row, so copies cost nothing.
    """
    if not 0 <= radius < blocks:
        raise ValueError("the radius must be less than the number of blocks")
    edges = [round(32 * k / blocks) for k in range(blocks + 1)]  # in digits
    pieces = [F.substring("fingerprint", a + 1, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    choices = list(combinations(range(blocks), blocks - radius))
    keys = F.array(*(F.concat(*(pieces[k] for k in choice)) for choice in choices))
    tables = prints.select("fingerprint").distinct().select("fingerprint", F.posexplode(keys).alias("table", "key"))
    a, b = tables.alias("a"), tables.alias("b")
    halves = [[F.conv(F.substring(f"{side}.fingerprint", 1 + 16 * k, 16), 16, -10).cast("long") for side in "ab"] for k in (0, 1)]
    distance = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in halves), F.lit(0))
    agreeing = F.array(*(
        F.concat(*(F.substring("a.fingerprint", edges[k] + 1, edges[k + 1] - edges[k]) for k in c))
        == F.concat(*(F.substring("b.fingerprint", edges[k] + 1, edges[k + 1] - edges[k]) for k in c))
        for c in choices
    ))
    return (
        a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key"))
               & (F.col("a.fingerprint") < F.col("b.fingerprint")))
        .withColumn("distance", distance.cast("int")).where(F.col("distance") <= radius)
        .where(F.array_position(agreeing, True) == F.col("a.table") + 1)
        .select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b"), "distance")
    )
