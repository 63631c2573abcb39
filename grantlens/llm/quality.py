"""Quality rules: counts that a text must pass, and a calibrated logistic regression over hashed n-grams.

``base``: a text fails with fewer than MIN_WORDS words, or if more than MAX_REPEATED percent of its words lie in
windows of WINDOW words that the text holds twice or more. Windows are found by hashes and compared word by word.

The regression sees the words and pairs of words of a text and its runs of CHARACTERS code points, with their
case, each hashed to one of 2^BITS places; a place weighs the logarithm of its count, and a text has length 1. It is
fitted to labelled rows, about ``per_class`` of each class drawn by a hash of the id, each weighing as many
labelled documents as it stands for. A third of them is held back: on it a logistic curve turns scores into the
probability that a text is good (Platt's targets, so that a separable sample gives no certainty). A text is
kept if it passes the base rules and its probability reaches KEEP.

A null or empty text has no words and fails. Several labels of a document count as the lowest; rows that repeat an
id are learned from once, by the text that sorts first. Without labels of both classes the probability
is the share of good labels (1 without any). Repeated rows and ties are judged alike. Texts are read whole, long
ones in chunks. An empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import BLANKS, stored, text_or_empty
from grantlens.llm.hashing import BASE, CHUNK, Tokens, grouped, mixed, tokens_of, windows

# The thresholds of the rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30  # percent of the words
KEEP = 0.5

BITS = 18
CHARACTERS = (3, 4)
PER_CLASS = 2000  # the bound of the labelled sample, per class
LEAST = 3  # texts of the sample that a place must occur in
RIDGE = 1e-4
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IN_WORD = np.ones(256, dtype=bool)  # bytes that begin a code point of a word
_IN_WORD[list(BLANKS)] = False
_IN_WORD[0x80:0xC0] = False


class Model(NamedTuple):
    weights: np.ndarray  # by place
    intercept: float
    slope: float  # of the calibration
    shift: float


def _per_text(hits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many of ``hits`` lie in each of the texts that one byte each separates."""
    sums = np.concatenate([[0], np.cumsum(hits)])
    ends = np.cumsum(lengths + 1) - 1
    return sums[ends] - sums[ends - lengths]


def _repeated_words(texts: list[bytes], tokens: Tokens) -> np.ndarray:
    """How many words of each text lie in windows that it holds more than once."""
    counts = np.diff(tokens.bounds)
    owner = np.repeat(np.arange(len(texts)), counts)
    found = windows(tokens.hashes, WINDOW)
    out = np.zeros(len(texts), dtype=np.int64)
    starts = np.arange(len(found))
    inside = owner[:len(found)] == owner[WINDOW - 1:] if len(found) else np.zeros(0, bool)
    starts = starts[inside]
    keys = mixed(found[inside] + owner[starts].astype(np.uint64) * BASE)
    order = np.argsort(keys, kind="stable")
    same = np.append(keys[order][1:] == keys[order][:-1], False)
    twice = np.zeros(len(keys), dtype=bool)
    twice[order] = same | np.append(False, same[:-1]) if len(same) else same
    candidates = starts[twice]
    for k in np.unique(owner[candidates]):
        words, first = texts[k].split(), tokens.bounds[k]
        own = candidates[owner[candidates] == k] - first
        spelled = [b" ".join(words[i:i + WINDOW]) for i in own]
        often = Counter(spelled)
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        at = np.array([i for i, s in zip(own, spelled, strict=True) if often[s] > 1], dtype=np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW, -1)
        out[k] = (np.cumsum(edges) > 0).sum()
    return out


def _repeated_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.strip(BLANKS))


def base_counts(texts: list[bytes], tokens: Tokens) -> pd.DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 texts."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    return pd.DataFrame({
        "n_words": np.diff(tokens.bounds).astype(np.int64),
        "word_chars": _per_text(_IN_WORD[data], lengths),
        "n_symbols": _per_text(_IS_SYMBOL[data], lengths),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": _repeated_words(texts, tokens),
    })


def _places(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with hashed places, ascending, and how often each pair occurs."""
    return np.unique(owner << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)


def _counted_places(texts: list[bytes], tokens: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    owner = np.repeat(np.arange(len(texts)), np.diff(tokens.bounds))
    yield _places(owner, tokens.hashes)
    if len(owner) > 1:
        pair = owner[1:] == owner[:-1]
        yield _places(owner[1:][pair], mixed(tokens.hashes[:-1] * BASE + tokens.hashes[1:])[pair])
    characters = [t.decode("utf-8", "replace") for t in texts]
    # a blank before and after each text: a run belongs to the text that its second character lies in
    codes = np.frombuffer((" " + "  ".join(characters) + " ").encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(c) + 2 for c in characters])
    for at in range(0, len(codes), CHUNK):
        for n in CHARACTERS:
            part = codes[at:at + CHUNK + n - 1].astype(np.uint64)
            held = owner[at:at + CHUNK + n - 1]
            size = len(part) - n + 1
            if size < 1:
                continue
            run = np.full(size, n, dtype=np.uint64)
            for k in range(n):
                run = run * BASE + part[k:k + size]
            inside = held[:size] == held[n - 1:]
            yield _places(held[:size][inside], mixed(run[inside]))


def features(texts: list[bytes], tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and weight of every place a text holds; the weights of a text have length 1."""
    keys, counts = (np.concatenate(x) for x in zip(*_counted_places(texts, tokens), strict=True))
    keys, back = np.unique(keys, return_inverse=True)
    weights = np.log1p(np.bincount(back, weights=counts, minlength=len(keys)))
    owner = keys >> BITS
    norms = np.sqrt(np.bincount(owner, weights=weights**2, minlength=len(texts)))
    return owner, keys & ((1 << BITS) - 1), weights / norms[owner]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Rows(NamedTuple):
    """Held places of rows, one after the other."""

    bounds: np.ndarray
    places: np.ndarray
    weights: np.ndarray

    def scores(self, by_place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.bounds) - 1)
        some = self.bounds[1:] > self.bounds[:-1]
        if some.any():  # sums in doubles of products in the weights' own type, which take half the memory
            products = by_place.astype(self.weights.dtype)[self.places]
            products *= self.weights
            out[some] = np.add.reduceat(products, self.bounds[:-1][some], dtype=np.float64)
        return out


def fit_weights(rows: Rows, good: np.ndarray, shares: np.ndarray, ridge: float = RIDGE, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and intercept of the penalised likelihood, by accelerated gradient steps.

    Rows have length 1 and shares sum to 1, so the likelihood bends by at most a half with the intercept.
    """
    places = np.unique(rows.places)
    at = np.searchsorted(places, rows.places).astype(np.int32)
    own = Rows(rows.bounds, at, rows.weights)
    lengths = np.diff(rows.bounds)
    step = 1 / (0.5 + ridge)
    momentum = (1 - np.sqrt(ridge * step)) / (1 + np.sqrt(ridge * step))
    w = ahead = np.zeros(len(places) + 1)  # the intercept last
    for _ in range(rounds):
        off = shares * (_sigmoid(own.scores(ahead[:-1]) + ahead[-1]) - good)
        pulls = np.repeat(off.astype(rows.weights.dtype), lengths)
        pulls *= rows.weights
        grad = np.append(np.bincount(at, weights=pulls, minlength=len(places)), off.sum())
        del pulls
        grad[:-1] += ridge * ahead[:-1]
        new = ahead - step * grad
        ahead, w = new + momentum * (new - w), new
    out = np.zeros(1 << BITS)
    out[places] = w[:-1]
    return out, float(w[-1])


def calibrated(scores: np.ndarray, good: np.ndarray, shares: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve from scores to the probability of a good row, by Newton's method."""
    n_good, n_bad = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.column_stack([scores, np.ones(len(scores))])
    c = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(x @ c)
        grad = x.T @ (shares * (p - target)) + np.array([1e-6 * (c[0] - 1), 0.0])
        bend = (x * (shares * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(bend, grad)
        c = c - move / max(1.0, np.abs(move).max() / 2)
    return max(float(c[0]), 0.0), float(c[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, text, good, stands_for of about ``per_class`` labelled documents of each class."""
    graded = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.min("quality") > 0).cast("int").alias("good"))
    counts = {r["good"]: r["count"] for r in graded.groupBy("good").count().collect()}  # two classes
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("quality")), 11) / float(1 << 53)

    def of_class(by_class) -> Column:
        return F.when(F.col("good") == 1, F.lit(by_class(counts.get(1, 0)))).otherwise(F.lit(by_class(counts.get(0, 0))))

    chosen = graded.where(draw < of_class(lambda n: min(1.0, per_class / max(n, 1)))).withColumn(
        "stands_for", of_class(lambda n: max(1.0, n / per_class)))
    # broadcast: about per_class ids of each of two classes
    return (
        docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "good", "stands_for").agg(F.min("text").alias("text"))
    )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    sample = stored(labelled_sample(docs, labels, per_class), "quality")

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, run in grouped(t.encode("utf-8", "replace") for t in batch["text"]):
                owner, places, weights = features(run, tokens_of(run))
                cuts = np.searchsorted(owner, np.arange(len(run) + 1))
                out = batch.iloc[first:first + len(run)][["doc_id", "good", "stands_for"]].copy()
                out["places"] = [places[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                out["weights"] = [weights[a:b].astype("<f4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield out

    columns = "doc_id long, good int, stands_for double, places binary, weights binary"
    # the bounded sample, a partition at a time
    found = list(sample.withColumn("doc_id", F.xxhash64("doc_id")).mapInPandas(held, columns).toLocalIterator())
    found.sort(key=lambda r: (r["doc_id"], r["good"], bytes(r["places"])))
    good = np.array([r["good"] for r in found], dtype=np.float64)
    shares = np.array([r["stands_for"] for r in found])
    if len(set(good)) < 2:
        p = float(good[0]) if len(good) else 1.0
        return Model(np.zeros(1 << BITS), 0.0, 0.0, 40.0 if p else -40.0)
    lengths = np.array([len(r["places"]) // 4 for r in found], dtype=np.int64)
    places = np.frombuffer(b"".join(bytes(r["places"]) for r in found), "<i4")
    weights = np.frombuffer(b"".join(bytes(r["weights"]) for r in found), "<f4")
    del found
    often = (np.bincount(places, minlength=1 << BITS) >= LEAST)[places]
    row = np.repeat(np.arange(len(good), dtype=np.int32), lengths)[often]
    places, weights = places[often], weights[often]
    bounds = np.searchsorted(row, np.arange(len(good) + 1))
    del row, often

    def part(rows: np.ndarray) -> tuple[Rows, np.ndarray, np.ndarray]:
        inside = np.concatenate([np.arange(bounds[k], bounds[k + 1], dtype=np.int32) for k in rows])
        ends = np.cumsum([0, *(bounds[k + 1] - bounds[k] for k in rows)])
        return Rows(ends, places[inside], weights[inside]), good[rows], shares[rows] / shares[rows].sum()

    # every third row of each class is held back, in the order of hashed ids; at least one stays on either side
    turn = np.zeros(len(good), dtype=np.int64)
    for value in (0.0, 1.0):
        turn[good == value] = np.arange((good == value).sum()) % 3
    learn, hold = np.flatnonzero(turn != 1), np.flatnonzero(turn == 1)
    by_place, intercept = fit_weights(*part(learn))
    if len(set(good[hold])) < 2:
        hold = learn
    rows, own, own_shares = part(hold)
    slope, shift = calibrated(rows.scores(by_place) + intercept, own, own_shares)
    return Model(by_place, intercept, slope, shift)


def judged(texts: list[str | None], model: Model) -> pd.DataFrame:
    parts = []
    for _, run in grouped((t or "").encode("utf-8", "replace") for t in texts):
        tokens = tokens_of(run)
        out = base_counts(run, tokens)
        owner, places, weights = features(run, tokens)
        scores = np.bincount(owner, weights=model.weights[places] * weights, minlength=len(run)) + model.intercept
        out["p_good"] = _sigmoid(model.slope * scores + model.shift)
        out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED * out["n_words"])
        out["kept"] = ~out["base_failed"] & (out["p_good"] >= KEEP)
        parts.append(out)
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def with_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, the base counts, p_good, base_failed, kept for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "p_good double, base_failed boolean, kept boolean")
    def judge(text: pd.Series) -> pd.DataFrame:
        return judged([t if isinstance(t, str) else None for t in text], shared.value)

    return docs.select("doc_id", judge("text").alias("found")).select("doc_id", "found.*")
