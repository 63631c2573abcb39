"""Language identification by nearest centroid over TF-IDF n-grams of bytes.

Texts become unit vectors of their 2-grams and 3-grams of bytes, each a dimension of its own, weighted by
document frequencies over all documents that may be learned from. Each language is described by several
centroids (spherical k-means over a sample of ``per_language`` texts), and a text has the language of the
centroid nearest by cosine. Grams that no learned text holds count towards a text's length only.

A text much farther from its nearest centroid than learned texts of that language are is rejected. How far
those are depends on how many different grams a text holds, so the distance comes, for every language and
number of grams, from a quantile of its sample and of pieces of it, each against the centroids without that text.

Nulls and texts without a letter are ``und`` with score 0 and rejected; so is every text where
nothing could be learned. Texts without a language are not learned from. Ties go to the language
that sorts first. Texts are read whole, in chunks. An empty table gives an empty result; columns
other than text and language are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.hashing import CHUNK, LETTERS

GRAMS = (1 << 24) + (1 << 16)  # 3-grams, then 2-grams
PER_LANGUAGE = 400  # the bound of the sample that centroids are fitted to, per language
CENTROIDS = 3
BANDS = 25  # of texts by the logarithm of their number of different grams
SELDOM = 0.01  # share of learned texts below whose score only seldom ones lie
NEAR = 0.5  # a text is rejected below this share of that score
STRAYS = 0.01  # share of a language's sample that a centroid must be nearest to
UNKNOWN = "und"

_ASCII_LETTER = re.compile("[A-Za-z]")


class Model(NamedTuple):
    languages: list[str]
    grams: np.ndarray  # those of the learned texts, ascending
    idf: np.ndarray  # of these grams, then of all others
    centroids: np.ndarray  # a row per gram
    owner: np.ndarray
    least: np.ndarray  # the score below which a text is rejected, by language and band


def has_letter(text: str | None) -> bool:
    return text is not None and bool(_ASCII_LETTER.search(text) or any(c.isalpha() for c in text))


def _grams(raw: bytes, at: int = 0) -> np.ndarray:
    """The 2-grams and 3-grams that begin in a chunk, by their places; runs of blanks do not count."""
    b = np.frombuffer(raw[at:at + CHUNK + 2], dtype=np.uint8).astype(np.int32)
    last = max(0, min(CHUNK, len(b) - 1))
    found = np.full((last, 2), -1, dtype=np.int32)
    if last:
        pair = b[:-1] << 8 | b[1:]
        keep = pair != 0x2020
        found[:, 0] = np.where(keep, pair + (1 << 24), -1)[:last]
        triple = np.where(keep[:-1] & keep[1:], pair[:-1] << 8 | b[2:], -1)[:last]
        found[:len(triple), 1] = triple
    found = found.ravel()
    return found[found >= 0]


def _letters(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(LETTERS)


def gram_counts(text: str) -> np.ndarray:
    """The different grams of a text, ascending, and how often each occurs."""
    raw = _letters(text)
    parts = [np.unique(_grams(raw, at), return_counts=True) for at in range(0, max(1, len(raw)), CHUNK)]
    if len(parts) == 1:
        return np.array(parts[0], dtype=np.int64)
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(grams))
    return np.array([grams, counts], dtype=np.int64)


def _weights(counted: np.ndarray, grams: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``grams`` and weights of a text's known grams; all its grams together have length 1."""
    place = np.searchsorted(grams, counted[0])
    known = place < len(grams)
    known[known] = grams[place[known]] == counted[0][known]
    place[~known] = len(grams)
    weights = np.log1p(counted[1]) * idf[place]
    weights /= max(np.linalg.norm(weights), 1e-12)
    return place[known], weights[known].astype(np.float32)


def _band(different: int) -> int:
    return min(BANDS, max(1, int(different).bit_length())) - 1


def pieces(text: str) -> Iterator[np.ndarray]:
    """Gram counts of pieces of a text, from its middle on: one for each band that it is long enough for."""
    raw = _letters(text)[:CHUNK]
    found = _grams(raw[len(raw) // 2:] + b" " + raw[:len(raw) // 2])
    firsts = np.sort(np.unique(found, return_index=True)[1])  # where a gram first occurs
    for band in range(_band(len(firsts)) + 1):
        if 1 << band <= len(firsts):
            yield np.array(np.unique(found[:firsts[(1 << band) - 1] + 1], return_counts=True), dtype=np.int64)


def least_scores(scores: list[tuple[int, float]]) -> np.ndarray:
    """The least score of each band, from bands and scores of texts that were learned from.

    It is a share of the SELDOM quantile. A band without texts has that of the shorter ones.
    """
    out = np.zeros(BANDS)
    for band in range(BANDS):
        seen = [s for b, s in scores if b == band]
        if seen:
            out[band] = NEAR * np.quantile(seen, SELDOM)
        elif band:
            out[band] = out[band - 1]
    return out


def _seeds(points: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k-means++: the first centre is any point, each further one is drawn by its distance to those before."""
    centres = [points[draw.integers(len(points))]]
    near = points @ centres[0]
    while len(centres) < min(k, len(points)):
        far = np.maximum(1.0 - near.astype(np.float64), 0.0)
        if far.sum() < 1e-6 * len(points):  # nothing but copies of the centres
            break
        centres.append(points[draw.choice(len(points), p=far / far.sum())])
        near = np.maximum(near, points @ centres[-1])
    return np.array(centres)


def _moved(points: np.ndarray, centres: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The centres after ``rounds`` of k-means, and the centre each point is then nearest to."""
    for _ in range(rounds):
        nearest = np.argmax(points @ centres.T, axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                mean = points[nearest == c].sum(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres, np.argmax(points @ centres.T, axis=1)


def clustered(points: np.ndarray, k: int, rounds: int = 8, restarts: int = 5) -> np.ndarray:
    """Spherical k-means from several draws of seeds; of these, the centres with most points near them.

    A centre that hardly anything is near to describes strays, such as texts with a wrong label: it
    starts again inside the largest cluster, and is left out only if it ends up with strays each time.
    """
    draw = np.random.default_rng(0)
    least = max(2.0, STRAYS * len(points)) if len(points) > k else 1.0
    best, most = points[:0], (-1, -1.0)
    for _ in range(restarts):
        centres = _seeds(points, k, draw)
        for _ in range(2 * k):
            centres, nearest = _moved(points, centres, rounds)
            sizes = np.bincount(nearest, minlength=len(centres))
            stray = np.flatnonzero(sizes < least)
            inside = np.flatnonzero(nearest == sizes.argmax())
            if not len(stray) or len(inside) < 2 * least:
                break
            centres[stray] = points[draw.choice(inside, len(stray), replace=False)]
        # strays do not say which centres are good: every point counts by the nearest centre that stays
        centres = centres[(sizes >= least) | (sizes == sizes.max())]
        found = (len(centres), float(np.max(points @ centres.T, axis=1).sum()))
        if found > most:
            best, most = centres, found
    return best


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """A model of the columns doc_id, text and lang. Document frequencies cover every row."""
    rows = labelled.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(GRAMS, dtype=np.int32), 0
        for batch in batches:
            for text in batch["text"]:
                seen[gram_counts(text)[0]] += 1
                n += 1
        at = np.flatnonzero(seen)
        # the gram GRAMS holds the number of documents
        yield pd.DataFrame({"gram": np.append(at, GRAMS), "n": np.append(seen[at], n)})

    counted = rows.select("text").mapInPandas(frequencies, "gram int, n long")
    totals = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the number of grams
    order = np.argsort(totals["gram"].to_numpy())
    grams, n = (totals[c].to_numpy()[order].astype(np.int64) for c in ("gram", "n"))
    docs = int(n[-1]) if len(n) else 0
    grams, n = grams[:-1].astype(np.int32), n[:-1]
    # grams never seen weigh most: they count towards a text's length, so that strange texts lie far off
    idf = np.append(np.log((1 + docs) / (1 + n)) + 1, np.log(1 + docs) + 1)

    # A draw by hash leaves some three times the sample of each language, however large it is; these
    # are ranked. There are as many counts as languages, like the centroids that come back below.
    drawn = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53))
    shares = [F.lit(x) for r in rows.groupBy("lang").count().collect()
              for x in (r["lang"], min(1.0, 3.0 * per_language / r["count"]))]
    if shares:
        drawn = drawn.where(F.col("draw") < F.element_at(F.create_map(*shares), F.col("lang")))
    by_language = Window.partitionBy("lang").orderBy("draw", "text")
    sample = drawn.withColumn("turn", F.row_number().over(by_language)).where(F.col("turn") <= per_language).select("text", "lang")

    shared = labelled.sparkSession.sparkContext.broadcast((grams, idf))

    def centre(group: pd.DataFrame) -> pd.DataFrame:
        grams, idf = shared.value
        texts = [t for t in group["text"] if has_letter(t)]
        counts = [gram_counts(t) for t in texts]
        held = [_weights(c, grams, idf) for c in counts]
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *(at for at, _ in held)]))
        points = np.zeros((len(texts), len(used)), dtype=np.float32)
        for k, (at, w) in enumerate(held):
            points[k, np.searchsorted(used, at)] = w
        found = clustered(points, centroids) if texts else np.zeros((0, len(used)), np.float32)
        nearest = np.argmax(points @ found.T, axis=1) if texts else np.zeros(0, np.int64)
        sums = np.array([points[nearest == c].sum(axis=0) for c in range(len(found))])
        scores = []
        for k, text in enumerate(texts):
            others = found.copy()
            left = sums[nearest[k]] - points[k]
            others[nearest[k]] = left / max(np.linalg.norm(left), 1e-12)
            for part in (counts[k], *pieces(text)):
                at, w = _weights(part, grams, idf)
                inside = np.searchsorted(used, at)
                scores.append((_band(len(part[0])), float((others[:, inside] @ w).max())))
        least = least_scores(scores).astype("<f8").tobytes()
        return pd.DataFrame({"lang": group["lang"].iloc[:1].repeat(len(found)).tolist(),
                             "places": [used[np.flatnonzero(c)].astype("<i4").tobytes() for c in found],
                             "centre": [c[np.flatnonzero(c)].astype("<f4").tobytes() for c in found],
                             "least": [least] * len(found)})

    centres = sample.groupBy("lang").applyInPandas(centre, "lang string, places binary, centre binary, least binary")
    found = centres.orderBy("lang", "centre").collect()  # a few per language
    languages = sorted({r["lang"] for r in found})
    table = np.zeros((len(grams), len(found)), dtype=np.float32)
    for k, r in enumerate(found):
        table[np.frombuffer(r["places"], "<i4"), k] = np.frombuffer(r["centre"], "<f4")
    least = {r["lang"]: np.frombuffer(r["least"], "<f8") for r in found}
    return Model(
        languages, grams, idf, table,
        np.array([languages.index(r["lang"]) for r in found], np.int64),
        np.array([least[name] for name in languages]).reshape(-1, BANDS),
    )


def predict(texts: list[str | None], model: Model) -> pd.DataFrame:
    lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), [True] * len(texts)
    for k, text in enumerate(texts):
        if len(model.owner) and has_letter(text):
            counted = gram_counts(text)
            at, weights = _weights(counted, model.grams, model.idf)
            near = weights @ model.centroids[at]
            owner = model.owner[near.argmax()]
            lang[k], score[k] = model.languages[owner], min(1.0, max(0.0, float(near.max())))
            # a text that shares no gram with any centroid is near to none
            rejected[k] = bool(score[k] <= 0 or score[k] < model.least[owner, _band(len(counted[0]))])
    return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})


def predictor(docs: DataFrame, model: Model):
    """A column function: text to a struct of lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(text: pd.Series) -> pd.DataFrame:
        return predict([t if isinstance(t, str) else None for t in text], shared.value)

    return language


def fold() -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3


def identified(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the rows of folds 0 and 2."""
    model = fit(docs.where(fold() != 1), **options)
    language = predictor(docs, model)
    return docs.select("doc_id", (fold() == 1).alias("held_out"), language("text").alias("found")).select(
        "doc_id", "held_out", "found.*"
    )


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept."""
    language = predictor(docs, fit(docs.where(fold() != 1), **options))
    return docs.where(~language("text")["rejected"])
