"""Severity of toxic texts by cumulative-link ordinal regression.

P(grade <= k) is a logistic function of threshold k less one score that all thresholds share; the
score adds the weights of the hashed features a text holds: its words, and the runs of five bytes in
and around them. The expected severity is the sum of P(grade > k). The model is fitted to a sample of
labelled rows, at most ``per_grade`` of each grade, each weighing as many labelled rows of its grade as it
stands for; features enter it if they tell grades apart by more than chance would.

A null or empty text holds no features. A row without label is only predicted. Where no grade above 0
is labelled, every severity is 0. Repeated rows and ties are scored alike. Texts are read whole, in
chunks. An empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import stored, text_or_empty
from grantlens.llm.hashing import CHUNK, LETTERS, grouped, word_tokens

BITS = 22
GRAM = 5
PER_GRADE = 4000  # the bound of the labelled sample, per grade
TELLING = 5.0  # standard deviations by which a feature must differ from chance
CLEAN = 0.25
LEAST = 5  # texts of the sample that a feature must be found in


class Model(NamedTuple):
    weights: np.ndarray  # by feature, most of them 0
    thresholds: np.ndarray  # ascending


def _features(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and features of the words, then of the byte runs, of texts that blanks separate."""
    hashes, starts, _ = word_tokens(raw)
    yield starts, (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    for at in range(0, len(raw) - GRAM + 1, CHUNK):
        b = np.frombuffer(raw[at:at + CHUNK + GRAM - 1], dtype=np.uint8).astype(np.uint64)
        n = len(b) - GRAM + 1
        gram = b[:n]
        for k in range(1, GRAM):
            gram = gram << np.uint64(8) | b[k:k + n]
        yield np.arange(at, at + n), (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def held_features(texts: list[str | None], only: np.ndarray | None = None) -> list[np.ndarray]:
    """The different features of each text; those with a true entry in ``only``, if given."""
    out: list[np.ndarray] = []
    raws = ((t or "").encode("utf-8", "replace").translate(LETTERS) for t in texts)
    for _, run in grouped(raws):
        lengths = np.array([len(x) + 1 for x in run])
        opens = np.cumsum(lengths) - lengths  # each text begins with a blank
        raw = b" " + b" ".join(run) + b" "
        owners, found = [], []
        for places, features in _features(raw):
            if only is not None:
                hit = only[features]
                places, features = places[hit], features[hit]
            owner = np.searchsorted(opens, places, side="right") - 1
            within = places + GRAM <= opens[owner] + lengths[owner] + 1
            if not len(owners):
                within[:] = True  # words lie in one text
            owners.append(owner[within])
            found.append(features[within])
        pairs = np.unique(np.concatenate(owners) << BITS | np.concatenate(found))
        owner = pairs >> BITS
        cuts = np.searchsorted(owner, np.arange(1, len(run)))
        out.extend(np.split(pairs & ((1 << BITS) - 1), cuts))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def exceedances(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each score (rows) and threshold (columns)."""
    return _sigmoid(scores[:, None] - thresholds[None, :])


def fit_arrays(held: list[np.ndarray], grades: np.ndarray, rounds: int = 500, ridge: float = 1e-5,
               stands_for: np.ndarray | None = None) -> Model:
    """Adam steps on the penalised likelihood of the held features; gaps of thresholds stay positive.

    A text counts as the number of texts it stands for (1 if not given).
    """
    levels = int(grades.max()) if len(grades) else 0
    weights = np.zeros(1 << BITS, dtype=np.float32)
    if not levels:
        return Model(weights, np.array([40.0]))
    words = np.unique(np.concatenate(held))
    lengths = [len(h) for h in held]
    row = np.repeat(np.arange(len(held)), lengths)
    col = np.searchsorted(words, np.concatenate(held))
    n, k = len(held), len(words)
    w, first, gaps = np.zeros(k), 1.0, np.zeros(levels - 1)  # gaps are logarithms
    share = np.full(n, 1 / n) if stands_for is None else stands_for / stands_for.sum()
    state = np.zeros((2, k + levels))
    every = np.arange(n)
    for turn in range(1, rounds + 1):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        above = exceedances(np.bincount(row, weights=w[col], minlength=n), thresholds)
        edges = np.column_stack([np.ones(n), above, np.zeros(n)])
        p = np.maximum(edges[every, grades] - edges[every, grades + 1], 1e-12)
        slopes = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        by_score = (slopes[every, grades] - slopes[every, grades + 1]) / p * share
        # threshold t is the upper edge of grade t and the lower one of grade t + 1
        by_threshold = np.array([
            ((np.where(grades == t, 1, 0) - np.where(grades == t + 1, 1, 0)) * slopes[:, t + 1] / p * share).sum()
            for t in range(levels)
        ])
        tail = np.cumsum(by_threshold[::-1])[::-1]
        grad = np.concatenate([
            np.bincount(col, weights=by_score[row], minlength=k) - ridge * w,
            tail[:1], tail[1:] * np.exp(gaps),
        ])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        step = 0.1 * (state[0] / (1 - 0.9**turn)) / (np.sqrt(state[1] / (1 - 0.99**turn)) + 1e-8)
        w = np.maximum(w + step[:k], 0.0)  # a feature never makes a text milder
        first += step[k]
        gaps = np.clip(gaps + step[k + 1:], -6, 6)
    weights[words] = w
    return Model(weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def graded_sample(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> DataFrame:
    """text, grade, stands_for of labelled rows: 0 not toxic, 1 toxic, 2 toxic and of low quality.

    A row stands for the labelled rows of its grade over those chosen. Rows are chosen by a hash of the id. Several labels of one document count as their maximum.
    """
    grade = F.when(F.col("toxic") == 0, 0).when(F.coalesce(F.col("quality"), F.lit(1)) == 0, 2).otherwise(1)
    order = Window.partitionBy("grade").orderBy(F.xxhash64("doc_id"), "doc_id")
    graded = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(grade).alias("grade"))
    shares = [F.lit(x) for r in graded.groupBy("grade").count().collect()  # a row per grade
              for x in (r["grade"], max(1.0, r["count"] / per_grade))]
    chosen = (
        graded.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_grade)
        .withColumn("stands_for", F.element_at(F.create_map(*shares), F.col("grade")) if shares else F.lit(1.0))
        .select("doc_id", "grade", "stands_for")
    )
    # broadcast: at most GRADES times per_grade pairs of numbers
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").select(
        "text", "grade", "stands_for"
    )


def telling_features(sample: DataFrame) -> np.ndarray:
    """Features found in graded texts more often than chance would have it, by over TELLING deviations.

    Shares are those of all labelled rows: a text of the sample counts as those it stands for. Of the texts
    that hold a feature, the share without a grade is at most CLEAN times the overall share:
    features that merely go with long texts are left out. Counted by Spark over the sample; what comes back is bounded by the number of features.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = held_features(batch["text"].tolist())
            for grade in sorted(set(batch["grade"])):
                own = [h for h, g in zip(held, batch["grade"], strict=True) if g == grade]
                seen, n = np.unique(np.concatenate(own), return_counts=True)
                yield pd.DataFrame({"feature": seen, "grade": grade, "texts": n})

    grades = sample.groupBy("grade").agg(F.count(F.lit(1)).alias("texts"), F.max("stands_for").alias("stands_for")).collect()
    total = sum(r["texts"] * r["stands_for"] for r in grades)
    if not total:
        return np.zeros(0, dtype=np.int64)
    share = sum(r["texts"] * r["stands_for"] for r in grades if r["grade"] > 0) / total
    # variance of graded - n * share for a feature that all texts hold alike often, per holding labelled text
    variance = sum(r["texts"] * r["stands_for"] ** 2 * ((r["grade"] > 0) - share) ** 2 for r in grades) / total
    each = F.element_at(F.create_map(*(F.lit(x) for r in grades for x in (r["grade"], r["stands_for"]))), F.col("grade"))
    counts = (
        sample.select("text", "grade").mapInPandas(count, "feature int, grade int, texts long")
        .withColumn("n", F.col("texts") * each)
        .groupBy("feature").agg(
            F.sum("texts").alias("texts"), F.sum("n").alias("n"),
            F.sum(F.when(F.col("grade") > 0, F.col("n")).otherwise(0.0)).alias("graded"),
        )
    )
    apart = F.col("graded") - F.col("n") * share > TELLING * F.sqrt(F.col("n") * variance)
    seldom_clean = F.col("n") - F.col("graded") <= CLEAN * (1 - share) * F.col("n")
    rows = counts.where((F.col("texts") >= LEAST) & apart & seldom_clean).select("feature").collect()
    return np.array(sorted(r["feature"] for r in rows), dtype=np.int64)


def fit(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> Model:
    sample = stored(graded_sample(docs, labels, per_grade), "graded")
    telling = np.zeros(1 << BITS, dtype=bool)
    telling[telling_features(sample)] = True
    chosen = np.flatnonzero(telling)

    @F.pandas_udf("array<int>")
    def features(text: pd.Series) -> pd.Series:
        only = np.zeros(1 << BITS, dtype=bool)
        only[chosen] = True
        return pd.Series([h.tolist() for h in held_features(text.tolist(), only)])

    rows = sample.select(features("text").alias("held"), "grade", "stands_for").collect()  # per_grade of each grade
    held = [np.array(r["held"], dtype=np.int64) for r in rows]
    return fit_arrays(held, np.array([r["grade"] for r in rows], dtype=np.int64),
                      stands_for=np.array([r["stands_for"] for r in rows], dtype=np.float64))


def severities(texts: list[str | None], model: Model) -> pd.DataFrame:
    held = held_features(texts, model.weights != 0)
    scores = np.array([model.weights[h].sum() for h in held], dtype=np.float64)
    above = exceedances(scores, model.thresholds)
    return pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0],
                         "grade": (above >= 0.5).sum(axis=1), "toxic": above[:, 0] >= 0.5})


def graded(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> DataFrame:
    """doc_id, severity (0 to the highest grade), p_toxic, grade, toxic for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_grade))

    @F.pandas_udf("severity double, p_toxic double, grade int, toxic boolean")
    def score(text: pd.Series) -> pd.DataFrame:
        return severities([t if isinstance(t, str) else None for t in text], shared.value)

    return docs.select("doc_id", score("text").alias("found")).select("doc_id", "found.*")
