"""Near-duplicate documents by circulant MinHash, confirmed on full sets.

A document's set holds the hashes of its different runs of five words, A to Z lowered. Two
permutations make all coordinates of a signature: one scatters the set, the other, shifted circularly by k,
gives coordinate k as its least value. ``BANDS`` bands of ``ROWS`` coordinates are bucket keys; a pair at the
threshold of 0.75 shares no bucket with a probability below 3e-7, one at 0.8 below 1e-9.

Components of the documents that are linked (equal parts at least 0.75 of all parts) are found
without comparing all pairs of a bucket:

* copies of a text are one row throughout;
* every row is compared with one member of its buckets, the least that it meets most often, and rows
  that are linked become one group;
* in buckets that still hold several groups, every row is compared with the likeliest member of another
  group, by signature, a few times over, as groups grow together from their nearest members;
* what then still lies in several groups is looked at in full: all pairs of different groups, each in
  the first bucket it shares, are compared if size and signature allow a link. A signature differs from the true
  likeness by five standard deviations before a linked pair is passed over. Such pairs become rows only while they
  are a few for each row; otherwise texts go to the buckets, full sets are compared there, and what comes
  out is links that join groups, fewer than the rows that went in.

Buckets are looked at by tasks of bounded size: large ones are cut in blocks, and each pair of blocks is a
task of its own. Buckets in which no pair is likely enough are not looked at again.

Every link is confirmed on the full sets before it counts. Nothing is capped and no group is collected.

A null text and one without words have an empty set and are linked with nothing. Texts of fewer than
five words are one part. Null ids take no part in choosing a component's id, which is null if there is no other. Repeated
rows are copies. An empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import stored, text_key, text_or_empty
from grantlens.llm.components import components
from grantlens.llm.hashing import LOWER, mixed, windows, word_tokens

WORDS = 5
PARTS_OF_100 = 75
BANDS = 40
ROWS = 4
SKETCH = 192
# Expected values at the threshold less five standard deviations: equal bits, equal coordinates.
SKETCH_LEAST = 143
EQUAL_LEAST = 92
NEAREST_TURNS = 3
PAIRS_A_ROW = 4
SMALL = 32  # members of a bucket that is looked at together with others
PAIRS_AT_ONCE = 1_000_000
BLOCK = 4096  # members of a bucket that meet in one task
SET_PARTS = 1000  # parts that count as one member where full sets meet
PARTS_AT_ONCE = 2_000_000
BROADCAST_IDS = 500_000  # ids that may be sent to every task

def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The different hashes of runs of ``words`` words of a text, A to Z lowered, ascending."""
    hashes, _, _ = word_tokens(text.encode("utf-8", "replace").translate(LOWER))
    n = min(len(hashes), words)
    if not n:
        return np.zeros(0, np.uint64)
    return np.unique(mixed(windows(hashes, n) + np.uint64(n)))


def _scattered(values: np.ndarray) -> np.ndarray:
    """The first permutation, of the 64-bit hashes; the upper half is kept."""
    return (mixed(values ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def _permute(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(values: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least of the second permutation shifted by k."""
    scattered = _scattered(values)
    out = np.full(size, np.uint32(0xFFFFFFFF), dtype=np.uint32)
    shifts = np.arange(size, dtype=np.uint32)
    for at in range(0, len(scattered), 4096):
        part = scattered[at:at + 4096]
        step = max(1, (1 << 17) // len(part))
        for k in range(0, size, step):
            least = _permute(part[None, :] + shifts[k:k + step, None]).min(axis=1)
            np.minimum(out[k:k + step], least, out=out[k:k + step])
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    table = sig.reshape(bands, rows).astype(np.uint64)
    keys = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, k])
    return keys.view(np.int64)


def sketch(sig: np.ndarray) -> bytes:
    """The lowest bit of each coordinate, and the next one of the first few, up to SKETCH bits."""
    bits = np.concatenate([sig & np.uint32(1), sig >> np.uint32(1) & np.uint32(1)])[:SKETCH]
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, bits, signatures, keys = [], [], [], []
        for text in batch["text"]:
            values = shingles(text)
            sizes.append(len(values))
            sig = signature(values)
            bits.append(sketch(sig))
            signatures.append(sig.tobytes())
            keys.append(band_keys(sig).tolist() if len(values) else [])
        yield pd.DataFrame({"tid": batch["tid"], "n": sizes, "sketch": bits, "signature": signatures, "buckets": keys})


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose sets have 75 of 100 parts in common."""
    known, values = None, None  # rows come ordered by b
    for batch in batches:
        keep = []
        for b, first, second in zip(batch["b"], batch["text_a"], batch["text_b"], strict=True):
            if b != known:
                known, values = b, shingles(second)
            other = shingles(first)
            both = len(np.intersect1d(values, other, assume_unique=True))
            keep.append(100 * both >= PARTS_OF_100 * (len(values) + len(other) - both))
        yield batch.loc[keep, ["a", "b"]]


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose tid is in ``ids``; they are not shuffled if the ids are few."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "tid", "left_semi")


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b that are linked. Only texts that occur in pairs are shuffled, if their ids are few."""
    pairs = stored(pairs, "pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct(), "ids")
    wanted = _among(texts.select("tid", "text"), ids)
    first = wanted.select(F.col("tid").alias("a"), F.col("text").alias("text_a"))
    second = wanted.select(F.col("tid").alias("b"), F.col("text").alias("text_b"))
    return stored(pairs.join(first, "a").join(second, "b").mapInPandas(_confirmed, "a long, b long"), "links")


def _best(candidates: DataFrame) -> DataFrame:
    """Of each tid the pair with the member it meets in most buckets."""
    met = candidates.groupBy("tid", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = met.groupBy("tid").agg(F.max(F.struct("n", "pivot"))["pivot"].alias("pivot"))
    return best.select(F.col("pivot").alias("a"), F.col("tid").alias("b"))


def _grouped(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (tid, label) after the groups that links (of tids) join have become one."""
    if links.isEmpty():
        return labels
    ends = links.join(labels.select(F.col("tid").alias("a"), F.col("label").alias("x")), "a").join(
        labels.select(F.col("tid").alias("b"), F.col("label").alias("y")), "b"
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(ends)
    return stored(
        labels.join(joined.withColumnRenamed("node", "label"), "label", "left")
        .select("tid", F.coalesce("component", "label").alias("label")), "labels",
    )


def _divided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, band, tid, label, size of the buckets that hold several groups."""
    named = members.select("bucket", "band", "tid").join(labels, "tid")
    inside = Window.partitionBy("bucket")
    seen = named.withColumns({"low": F.min("label").over(inside), "high": F.max("label").over(inside),
                              "size": F.count(F.lit(1)).over(inside)})
    return seen.where("low <> high").drop("low", "high")


class Rows:
    """Members of several buckets, one bucket (or pair of its blocks) after the other."""

    def __init__(self, table: pd.DataFrame):
        self.bucket, self.band, self.tid, self.label, self.n, self.part, self.i, self.j = (
            table[c].to_numpy() for c in ("bucket", "band", "tid", "label", "n", "part", "i", "j"))
        self.sketch = np.frombuffer(b"".join(table["sketch"]), dtype=np.uint64).reshape(len(table), -1)
        self.signature = np.frombuffer(b"".join(table["signature"]), dtype=np.uint32).reshape(len(table), -1)
        self.text = table["text"] if "text" in table else None

    def bounds(self) -> np.ndarray:
        """Where a bucket (or pair of blocks) begins, and the end."""
        keys = np.stack([self.bucket, self.i, self.j])
        return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(self.bucket)]])

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that meet: small buckets many at a time, others row by row against all."""
        edges = self.bounds()
        starts, sizes = edges[:-1], np.diff(edges)
        small = (sizes <= SMALL) & (self.i[starts] == self.j[starts])
        for size in np.unique(sizes[small]).tolist():
            x, y = np.triu_indices(size, 1)
            own = starts[small & (sizes == size)]
            step = max(1, PAIRS_AT_ONCE // max(1, len(x)))
            for at in range(0, len(own), step):
                yield (own[at:at + step, None] + x).ravel(), (own[at:at + step, None] + y).ravel()
        for start, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
            part = self.part[start:start + size]
            rows = start + np.flatnonzero(part == self.i[start])
            cols = start + np.flatnonzero(part == self.j[start])
            step = max(1, PAIRS_AT_ONCE // max(1, len(cols)))
            for at in range(0, len(rows), step):
                r = rows[at:at + step]
                good = self.label[r, None] != self.label[None, cols]
                if self.i[start] == self.j[start]:
                    good &= r[:, None] < cols[None, :]
                x, y = np.nonzero(good)
                yield r[x], cols[y]

    def likely(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of different groups that may be linked: rows a, b, equal coordinates, and if this is their first bucket."""
        for a, b in self.candidates():
            low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
            good = (self.label[a] != self.label[b]) & (100 * low >= PARTS_OF_100 * high)
            a, b = a[good], b[good]
            unlike = np.bitwise_count(self.sketch[a] ^ self.sketch[b]).sum(axis=1)
            good = unlike <= SKETCH - SKETCH_LEAST
            a, b = a[good], b[good]
            for at in range(0, len(a), 50_000):
                x, y = a[at:at + 50_000], b[at:at + 50_000]
                same = self.signature[x] == self.signature[y]
                equal = same.sum(axis=1)
                good = equal >= EQUAL_LEAST
                shared = same[good].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
                yield x[good], y[good], equal[good], shared == self.band[x[good]]


def _nearest(rows: Rows) -> pd.DataFrame:
    """Each row that may be linked with another group, the likeliest row there, and its pairs new in this bucket.

    ``first`` says whether the row has such a pair, from either side.
    """
    new = np.zeros(len(rows.tid), dtype=bool)
    best, pairs = np.full(len(rows.tid), -1, dtype=np.int64), np.zeros(len(rows.tid), dtype=np.int64)
    for a, b, equal, first in rows.likely():
        np.add.at(pairs, a, first)
        new[a[first]] = new[b[first]] = True
        for x, y in ((a, b), (b, a)):
            np.maximum.at(best, x, equal * len(best) + y)
    found = np.flatnonzero(best >= 0)
    other = best[found] % len(best)
    return pd.DataFrame({"bucket": rows.bucket[found], "band": rows.band[found], "tid": rows.tid[found],
                         "other": rows.tid[other], "equal": best[found] // len(best), "pairs": pairs[found], "first": new[found]})


def _every(rows: Rows) -> pd.DataFrame:
    """All pairs of different groups that may be linked, in the first bucket they share."""
    pairs = [(rows.tid[a[first]], rows.tid[b[first]]) for a, b, _, first in rows.likely()]
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (rows.tid[:0], rows.tid[:0])
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


class Sets:
    """The full sets of texts, their parts numbered, to be compared one with many."""

    def __init__(self, texts: pd.Series):
        sets = [shingles(t) for t in texts]
        self.size = np.array([len(x) for x in sets], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        known, self.parts = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(known), dtype=bool)

    def linked(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of the others have 75 of 100 parts in common with one; none is empty."""
        own = self.parts[self.start[one]:self.start[one] + self.size[one]]
        sizes = self.size[others]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.start[others] - first, sizes) + np.arange(sizes.sum())
        self.mark[own] = True
        both = np.add.reduceat(self.mark[self.parts[at]], first, dtype=np.int64)
        self.mark[own] = False
        return 100 * both >= PARTS_OF_100 * (sizes + self.size[one] - both)


def _forest(rows: Rows) -> pd.DataFrame:
    """Links of full sets, each between groups that the ones before it leave apart: fewer than the rows."""
    # a text that lies in several of these buckets is taken apart once
    _, where, text_of = np.unique(rows.tid, return_index=True, return_inverse=True)
    sets = Sets(rows.text.iloc[where])
    _, group = np.unique(rows.label, return_inverse=True)
    links = []
    for a, b, _, first in rows.likely():
        if not first.any():
            continue
        order = np.argsort(a[first], kind="stable")
        a, b = a[first][order], b[first][order]
        ones, starts = np.unique(a, return_index=True)
        for one, others in zip(ones.tolist(), np.split(b, starts[1:]), strict=True):
            others = others[group[others] != group[one]]
            while len(others):
                step = max(1, PARTS_AT_ONCE // int(sets.size[text_of[others]].max()))
                looked, others = others[:step], others[step:]
                for other in looked[sets.linked(text_of[one], text_of[looked])].tolist():
                    if group[other] != group[one]:
                        links.append((rows.tid[one], rows.tid[other]))
                        group[group == group[other]] = group[one]
                others = others[group[others] != group[one]]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _whole_buckets(look):
    """``look`` over batches that end where a bucket ends; what is held back is one bucket at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["bucket", "i", "j"]].to_numpy()
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
            if last or (held and (held[-1][["bucket", "i", "j"]].to_numpy()[-1] != keys[0]).any()):
                yield look(Rows(pd.concat([*held, batch.iloc[:last]], ignore_index=True)))
                held = []
            held.append(batch.iloc[last:])
        if held:
            yield look(Rows(pd.concat(held, ignore_index=True)))

    return run


_PAIRS = "a long, b long"
_NEAR = "bucket long, band int, tid long, other long, equal long, pairs long, first boolean"


def _looked_at(divided: DataFrame, sketches: DataFrame, look, schema: str, texts: DataFrame | None = None) -> DataFrame:
    """``look`` over the rows of each bucket, large ones by pairs of blocks; with texts, where ``texts`` is given."""
    divided = stored(divided.select("bucket", "band", "tid", "label", "size"), "divided")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    ids = stored(divided.select("tid").distinct(), "ids")
    wanted, columns = _among(sketches.select("tid", "n", "sketch", "signature"), ids), []
    if texts is not None:
        wanted, columns = wanted.join(_among(texts.select("tid", "text"), ids), "tid"), ["text"]
        parts = divided.join(_among(sketches.select("tid", "n"), ids), "tid").groupBy("bucket").agg(F.sum("n").alias("parts"))
        heavy = F.ceil(F.col("parts") / SET_PARTS)
        divided = divided.join(parts, "bucket").withColumn("size", F.greatest("size", heavy)).drop("parts")
    return (
        divided.join(wanted, "tid")
        .withColumn("part", F.pmod(F.xxhash64("tid"), blocks).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"i": F.least("part", "with"), "j": F.greatest("part", "with")})
        .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        .select("bucket", "band", "tid", "label", "n", "part", "i", "j", "sketch", "signature", *columns)
        .mapInPandas(_whole_buckets(look), schema)
    )


def _every_pair(members: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    return _looked_at(_divided(members, labels), sketches, _every, _PAIRS).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """key, n_shingles, component, component_id for each different text of ``docs``.

    ``component`` names the group, ``component_id`` is the smallest id of its documents.
    """
    texts = stored(
        docs.select(text_key().alias("key"), text_or_empty().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
        .groupBy("key").agg(F.first("text").alias("text"), F.min("doc_id").alias("least"))
        .withColumn("tid", F.monotonically_increasing_id()), "texts",
    )
    sketches = stored(texts.select("tid", "text").mapInPandas(
        _sketches, "tid long, n long, sketch binary, signature binary, buckets array<long>"), "sketches")
    rows = sketches.select(F.posexplode("buckets").alias("band", "bucket"), "tid")
    # one shuffle: hardly any bucket has two members, so counting them first would shuffle as many rows again
    inside = Window.partitionBy("bucket")
    met = rows.withColumns({"pivot": F.min("tid").over(inside), "size": F.count(F.lit(1)).over(inside)})
    members = stored(met.where("size > 1").drop("size"), "members")

    links = linked(_best(members.where("tid <> pivot")), texts)
    labels = _grouped(stored(sketches.select("tid", F.col("tid").alias("label")), "labels"), links)
    for _ in range(NEAREST_TURNS):
        near = stored(_looked_at(_divided(members, labels), sketches, _nearest, _NEAR), "nearest")
        pairs, rows_left = near.agg(F.sum("pairs"), F.count_distinct("tid")).first()
        if not rows_left:
            break
        # a row is done with a bucket where it may be linked with no other group, or only with rows it met in one before
        members = stored(near.where("first").select("bucket", "band", "tid").distinct(), "members")
        if pairs <= PAIRS_A_ROW * rows_left:  # all pairs are hardly more than the nearest ones
            labels = _grouped(labels, linked(_every_pair(members, labels, sketches), texts))
            break
        nearest = near.groupBy("tid").agg(F.max(F.struct("equal", "other"))["other"].alias("other"))
        pairs = nearest.select(F.least("tid", "other").alias("a"), F.greatest("tid", "other").alias("b")).distinct()
        links = linked(pairs, texts)
        labels = _grouped(labels, links)
    else:
        forest = _looked_at(_divided(members, labels), sketches, _forest, _PAIRS, texts)
        labels = _grouped(labels, stored(forest, "links"))

    named = texts.select("key", "tid", "least").join(labels, "tid").join(sketches.select("tid", "n"), "tid")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return stored(named.join(least, "label").select(
        "key", F.col("n").alias("n_shingles"), F.col("label").alias("component"), "component_id"), "components")


def with_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    found = near_duplicates(docs.select("doc_id", "text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(found, "key").select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: one of each group, and every text without words.

    Of a group its row with the smallest id stays (null ids come last, then the smallest key of the
    text decides; of repeated rows any one). Ids are decided without texts; texts are shuffled once, by id.
    """
    source = docs.select("doc_id", "text")
    found = near_duplicates(source)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = source.select(name.alias("id"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    named = rows.join(found, "key").groupBy("id", "doc_id", "key").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("component").alias("component"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "id")
    first = named.where("n_shingles > 0").groupBy("component").agg(F.min(place).alias("place"))
    stay = first.select("place.id", "place.key").unionByName(named.where("n_shingles = 0").select("id", "key"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), name.alias("id"), text_key().alias("key"))
    order = Window.partitionBy("id", "key").orderBy("key")
    return whole.join(stay, ["id", "key"]).withColumn("turn", F.row_number().over(order)).where(
        "turn = 1"
    ).select("row.*")
