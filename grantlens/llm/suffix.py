"""Remove repeated byte strings, found by longest-previous-factor arrays over suffix arrays.

Strings of ``length`` bytes are judged on the input: every byte covered by a string that also starts
anywhere else, in the same text or another, goes.

Only places that can matter are sorted. Of each string the smallest hash of its parts of ``ANCHOR``
bytes is its anchor (the leftmost, if several are smallest), so equal strings have equal anchors; neighbouring strings
with one anchor are a run. Runs that agree on all they touch are settled at once, runs whose anchor
occurs once are dropped (see ``repeats``). The others go, as bytes, to the shard of their anchor, where all
strings that could equal them are. A shard sorts its suffixes, takes the common prefixes of neighbours, and gets for
each place the longest match with an earlier one (through the previous and next smaller places in
suffix order) and, by the same pass over places in reverse, with a later one.

An anchor with more than ``group_limit`` different runs is too large for a shard. Its strings are compared by 128 bits of
hashes instead, first in blocks of ``BLOCK`` neighbours, then singly where blocks leave it open, which
splits the group over all tasks; the result is the same.

A null text is an empty one. Copies of a text are worked on once and lose everything if they are long
enough. Ids may repeat or be null, since texts go by their content. An empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import distinct_texts, stored, text_key
from grantlens.llm.hashing import byte_values, mixed, windows
from grantlens.llm.repeats import RUNS, by_text, collapsed, judged, marked, merged, places, unfolded

LENGTH = 400
ANCHOR = 280
BLOCK = 21
GROUP_LIMIT = 2000  # different runs of one anchor that a shard takes
SHARD_RUNS = 2000  # runs that a shard holds on average

_SECOND = np.uint64(0xA0761D6478BD642F)
_PLACE_BITS = np.uint64(28)  # low bits of a sort key that hold a place


def raw_bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` consecutive values, by doubling."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (n - size)], values[n - size:]) if n > size else values


def anchors(values: np.ndarray, length: int, short: int, step: int = 1 << 22) -> np.ndarray:
    """The place of the anchor of each string of ``length``, worked through ``step`` strings at a time."""
    count, span = len(values) - length + 1, length - short + 1
    out = []
    for at in range(0, max(count, 0), step):
        stop = min(at + step, count)
        hashes = windows(values[at:stop + length - 1], short)
        keys = hashes >> _PLACE_BITS << _PLACE_BITS | np.arange(len(hashes), dtype=np.uint64)
        low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        out.append((sliding_least(keys, span) & low).astype(np.int64) + at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _padded(values: np.ndarray, margin: int) -> np.ndarray:
    edge = np.zeros(margin, np.uint64)
    return np.concatenate([edge, values, edge])


def _joined(parts: list[tuple]) -> Iterator[pd.DataFrame]:
    if parts:
        yield collapsed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _runs(length: int, short: int):
    margin = length - short

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for tid, text in zip(batch["tid"], batch["text"], strict=True):
                raw = raw_bytes(text)
                if len(raw) < length:
                    continue
                values = byte_values(raw)
                owner = anchors(values, length, short)
                a = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                b = np.concatenate([a[1:], [len(owner)]]) - 1
                at = owner[a]
                parts.append((
                    windows(values, short)[at], windows(_padded(values, margin), length + margin)[at],
                    np.full(len(a), tid), a, b,
                ))
            yield from _joined(parts)

    return run


def _blocks(length: int, short: int, block: int):
    """The open runs in blocks of strings, counted from the anchor backwards."""
    margin = block - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for tid, text, runs in zip(batch["tid"], batch["text"], batch["open_runs"], strict=True):
                values = byte_values(raw_bytes(text))
                at = places(*unfolded(runs))
                owner = anchors(values, length, short)[at]
                number = (owner - at) // block
                cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner) != 0) | (np.diff(number) != 0)]))
                a, b = at[cut], at[np.concatenate([cut[1:], [len(at)]]) - 1]
                top = owner[cut] - block * number[cut]  # the last place of the block
                salt = number[cut].astype(np.uint64) * _SECOND
                parts.append((
                    mixed(windows(values, length - margin)[top] + salt),
                    windows(_padded(values, margin), length + margin)[top], np.full(len(a), tid), a, b,
                ))
            yield from _joined(parts)

    return run


def _single(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for tid, text, runs in zip(batch["tid"], batch["text"], batch["open_runs"], strict=True):
                values = byte_values(raw_bytes(text))
                at = places(*unfolded(runs))
                other = windows(mixed(values ^ _SECOND), length)
                parts.append((windows(values, length)[at], other[at], np.full(len(at), tid), at, at))
            yield from _joined(parts)

    return run


def suffix_order(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of one length in order, and how many bytes each shares with the one before."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    shared = np.zeros(len(order), dtype=np.int64)
    width, step = len(suffixes[0]) if suffixes else 0, 16384
    for at in range(1, len(order), step):
        stop = min(at + step, len(order))
        table = np.frombuffer(b"".join([suffixes[k] for k in order[at - 1:stop]]), np.uint8).reshape(-1, width)
        equal = table[1:] == table[:-1]
        shared[at:stop] = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
    return np.array(order, dtype=np.int64), shared


def longest_previous(ranks: list[int], shared: list[int]) -> list[int]:
    """For each rank the longest match with a smaller one; ranks 0 to n - 1 in suffix order.

    A stack of ascending ranks holds the previous smaller ones; whoever is taken off it has met the
    next smaller one. The match with either is the least shared prefix on the way.
    """
    out = [0] * len(ranks)
    stack: list[tuple[int, int]] = []
    for rank, common in zip([*ranks, -1], [*shared, 0], strict=True):
        while stack and stack[-1][0] > rank:
            top, before = stack.pop()
            if before > common:
                out[top] = before
            else:
                out[top] = common
                common, before = before, common
        stack.append((rank, common))
    return out


def matches(suffixes: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest matches of each suffix with an earlier and with a later place; ``ranks`` orders the places."""
    order, shared = suffix_order(suffixes)
    in_order, common = ranks[order], shared.tolist()
    earlier = np.array(longest_previous(in_order.tolist(), common), dtype=np.int64)
    later = np.array(longest_previous((len(order) - 1 - in_order).tolist(), common), dtype=np.int64)[::-1]
    return earlier[ranks], later[ranks]


def _segments(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tid, text, runs in zip(batch["tid"], batch["text"], batch["open_runs"], strict=True):
                raw = raw_bytes(text)
                out.extend((r["shard"], tid, r["a"], raw[r["a"]:r["b"] + length]) for r in runs)
            yield pd.DataFrame(out, columns=["shard", "tid", "a", "bytes"])

    return run


def _search(length: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.drop_duplicates(["tid", "a"]).sort_values(["tid", "a"])
        suffixes, tid, place = [], [], []
        for t, a, raw in zip(shard["tid"], shard["a"], shard["bytes"], strict=True):
            n = len(raw) - length + 1
            suffixes.extend(raw[k:k + length] for k in range(n))
            tid.append(np.full(n, t))
            place.append(np.arange(a, a + n))
        earlier, later = matches(suffixes, np.arange(len(suffixes)))
        hit = np.maximum(earlier, later) >= length
        t, p = np.concatenate(tid)[hit], np.concatenate(place)[hit]
        t, a, b = merged(t, p, p)
        return pd.DataFrame({"tid": t, "a": a, "b": b})

    return run


def _cut(length: int, with_text: bool):
    columns = ["key", "n_rows", "text", "settled_runs", "found_runs", "block_runs", "single_runs"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, n_rows, text, *lists in batch[columns].itertuples(index=False):
                data = np.frombuffer(raw_bytes(text), dtype=np.uint8)
                n = len(data)
                if n_rows > 1 and n >= length:
                    gone = np.ones(n, dtype=bool)
                else:
                    gone = marked(n, *(np.concatenate(x) for x in zip(*map(unfolded, lists), strict=True)), length)
                kept = data[~gone].tobytes()
                spans = np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])) if n else 0
                out.append((key, n, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            yield pd.DataFrame(out, columns=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def cut_texts(docs: DataFrame, length: int = LENGTH, short: int = ANCHOR, group_limit: int = GROUP_LIMIT,
              with_text: bool = True) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, kept (if ``with_text``) for each different text."""
    texts = stored(distinct_texts(docs).withColumn("tid", F.monotonically_increasing_id()), "texts")
    narrow = texts.select("tid", "text")
    near = stored(judged(narrow.mapInPandas(_runs(length, short), RUNS)), "runs")
    opened = near.where("NOT settled").select("core", "tid", "a", "b")
    sizes = stored(opened.groupBy("core").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.where(F.col("n") <= group_limit).agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("core"), F.lit(max(1, -(-total // SHARD_RUNS))))
    small = opened.join(sizes.where(F.col("n") <= group_limit), "core").groupBy("tid").agg(
        F.collect_list(F.struct(shard.alias("shard"), "a", "b")).alias("open_runs")
    )
    found = (
        narrow.join(small, "tid").mapInPandas(_segments(length), "shard long, tid long, a int, bytes binary")
        .groupBy("shard").applyInPandas(_search(length), "tid long, a int, b int")
    )
    large = opened.join(sizes.where(F.col("n") > group_limit), "core").withColumn("settled", F.lit(False))
    large = narrow.join(by_text(large, False, "open_runs"), "tid")
    blocks = stored(judged(large.mapInPandas(_blocks(length, short, BLOCK), RUNS)), "blocks")
    rest = narrow.join(by_text(blocks, False, "open_runs"), "tid")
    single = judged(rest.mapInPandas(_single(length), RUNS))
    whole = (
        texts.join(by_text(near, True, "settled_runs"), "tid", "left")
        .join(by_text(found.withColumn("settled", F.lit(True)), True, "found_runs"), "tid", "left")
        .join(by_text(blocks, True, "block_runs"), "tid", "left")
        .join(by_text(single, True, "single_runs"), "tid", "left")
    )
    return whole.mapInPandas(
        _cut(length, with_text),
        "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    results = stored(cut_texts(docs, length, with_text=False, **options).drop("kept"), "cut")
    return docs.select("doc_id", text_key().alias("key")).join(results, "key").drop("key")
