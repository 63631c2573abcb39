"""Remove repeated runs of words, found by difference-cover anchors.

Windows of ``length`` words are judged on the input: every word covered by a window whose words also
start anywhere else, in the same text or another, goes. Hashes are taken only of short windows at
*cover positions*: those whose number modulo ``PERIOD`` is in ``COVER``, a set whose differences are all numbers below
the period. For any two places there is a shift below the period that takes both to cover positions,
so equal windows of ``length`` words share an aligned anchor of ``length - PERIOD + 1`` words. Anchors that
meet are extended to all windows around them (see ``repeats``); windows are compared by 128 bits.

A null text is an empty one. Texts shorter than a window lose nothing. Copies of a text are worked on once and
lose everything that can lie in a window. An empty table gives an empty result; further columns are
not looked at. Texts are read whole; ids may repeat or be null, since texts go by their content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import distinct_texts, stored, text_key
from grantlens.llm.hashing import grouped, mixed, tokens_of, windows, word_tokens
from grantlens.llm.repeats import RUNS, by_text, collapsed, judged, marked, places, unfolded

LENGTH = 35
PERIOD = 21
AT_ONCE = 200_000  # anchors that are sorted and handed on together
COVER = (3, 6, 7, 12, 14)  # all of 0 to 20 are differences of two of these modulo 21

_SECOND = np.uint64(0xA0761D6478BD642F)


def _anchors(length: int):
    short, margin = length - PERIOD + 1, PERIOD - 1
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, held = [], 0
            tids = batch["tid"].to_numpy()
            for first, texts in grouped(t.encode("utf-8", "replace") for t in batch["text"]):
                tokens = tokens_of(texts)
                sizes = np.diff(tokens.bounds)
                # zeros between texts: what a run holds of its text ends where the text does
                opens = margin + tokens.bounds[:-1] + margin * np.arange(len(texts))
                padded = np.zeros(len(tokens.hashes) + margin * (len(texts) + 1), np.uint64)
                within = np.arange(len(tokens.hashes)) - np.repeat(tokens.bounds[:-1], sizes)
                padded[np.repeat(opens, sizes) + within] = tokens.hashes
                left = np.repeat(sizes, sizes) - within
                at = np.flatnonzero(cover[within % PERIOD] & (left >= short) & (np.repeat(sizes, sizes) >= length))
                owner = np.repeat(np.arange(len(texts)), sizes)[at]
                place = within[at]
                spot = opens[owner] + place
                parts.append((
                    windows(padded, short)[spot], windows(padded, length + margin)[spot - margin],
                    tids[first + owner], np.maximum(place - margin, 0), np.minimum(place, sizes[owner] - length),
                ))
                held += len(at)
                if held >= AT_ONCE:
                    yield collapsed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts, held = [], 0
            if parts:
                yield collapsed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return run


def _windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for tid, text, runs in zip(batch["tid"], batch["text"], batch["open_runs"], strict=True):
                hashes, _, _ = word_tokens(text.encode("utf-8", "replace"))
                at = places(*unfolded(runs))
                other = mixed(hashes ^ _SECOND)
                parts.append((windows(hashes, length)[at], windows(other, length)[at], np.full(len(at), tid), at, at))
            if parts:
                yield collapsed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return run


def _cut(length: int, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, n_rows, *lists in batch[["key", "text", "n_rows", "settled_runs", "found_runs"]].itertuples(index=False):
                raw = text.encode("utf-8", "replace")
                words = raw.split()
                n = len(words)
                if n_rows > 1 and n >= length:
                    gone = np.ones(n, dtype=bool)
                else:
                    ends = [np.concatenate(x) for x in zip(*map(unfolded, lists), strict=True)]
                    gone = marked(n, *ends, length)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
                out.append((key, n, int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            kept.decode() if with_text else None))
            yield pd.DataFrame(out, columns=["key", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def cut_texts(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """key, n_words, n_removed, kept_sha256, kept (if ``with_text``) for each different text of ``docs``."""
    if length <= PERIOD:
        raise ValueError(f"windows must be longer than {PERIOD} words")
    texts = stored(distinct_texts(docs).withColumn("tid", F.monotonically_increasing_id()), "texts")
    narrow = texts.select("tid", "text")
    near = stored(judged(narrow.mapInPandas(_anchors(length), RUNS)).select("tid", "a", "b", "settled"), "anchors")
    open_texts = narrow.join(by_text(near, False, "open_runs"), "tid")
    single = judged(open_texts.mapInPandas(_windows(length), RUNS))
    found = texts.join(by_text(near, True, "settled_runs"), "tid", "left").join(
        by_text(single, True, "found_runs"), "tid", "left"
    )
    return found.mapInPandas(
        _cut(length, with_text), "key binary, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    results = stored(cut_texts(docs, length, with_text=False).drop("kept"), "cut")
    return docs.select("doc_id", text_key().alias("key")).join(results, "key").drop("key")
