"""Base counts against plain loops, the regression by its gradient, its calibration and held-out labels."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute_force import prose
from grantlens.llm import quality
from grantlens.llm.hashing import tokens_of

LABELS = "doc_id long, quality int, toxic int"


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often = Counter(seen)
    covered = {k + i for k, window in enumerate(seen) if often[window] > 1 for i in range(8)}
    lines = text.split("\n")
    again = sum(1 for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:k])
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))


def counted(texts):
    raws = [(t or "").encode() for t in texts]
    frame = quality.base_counts(raws, tokens_of(raws))
    return [tuple(int(v) for v in r) for r in frame.itertuples(index=False)]


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a " * 9, "a b c d e f g h " * 2, "x y\nx y\n\n\nx y \n x y", "#*$%&|<> é漢 b",
    "a b c d e f g h i a b c d e f g h", "é ß\x0b漢字\x0c\U0001F600 |", "w " * 4 + "\n" + "w " * 4, "\n\n\n", "x" * 5000,
]


def test_base_counts_equal_plain_loops():
    draw = random.Random(5)
    texts = TEXTS + [" ".join(draw.choice(["a", "b", "c\nc", "#", "é"]) for _ in range(draw.randint(0, 60))) for _ in range(200)]
    assert counted(texts) == [counts_by_hand(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é ", max_size=80), max_size=6))
def test_base_counts_of_any_text(texts):
    assert counted(texts) == [counts_by_hand(t) for t in texts]


def test_places_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    texts = [prose(900, 1).encode(), b"", prose(40, 2, "äöü漢").encode()]
    whole = quality.features(texts, tokens_of(texts))
    monkeypatch.setattr(quality, "CHUNK", 64)
    for a, b in zip(whole, quality.features(texts, tokens_of(texts)), strict=True):
        assert np.array_equal(a, b)


def test_places_do_not_depend_on_neighbours():
    texts = [prose(30, k).encode() for k in range(5)]
    owner, places, weights = quality.features(texts, tokens_of(texts))
    for k, text in enumerate(texts):
        _, alone, own = quality.features([text], tokens_of([text]))
        assert np.array_equal(places[owner == k], alone) and np.allclose(weights[owner == k], own)
        assert np.isclose((own**2).sum(), 1)


def test_fit_ends_where_the_gradient_vanishes():
    draw = np.random.default_rng(1)
    dense = (draw.random((60, 12)) < 0.3) * 1.0
    dense /= np.maximum(np.linalg.norm(dense, axis=1), 1)[:, None]
    good = (dense[:, 0] + 0.3 * draw.standard_normal(60) > 0.1) * 1.0
    shares = draw.random(60)
    shares /= shares.sum()
    row, col = np.nonzero(dense)
    rows = quality.Rows(np.searchsorted(row, np.arange(61)), col, dense[row, col])
    w, intercept = quality.fit_weights(rows, good, shares, ridge=1e-2, rounds=3000)
    off = shares * (1 / (1 + np.exp(-(dense @ w[:12] + intercept))) - good)
    assert np.abs(dense.T @ off + 1e-2 * w[:12]).max() < 1e-6 and abs(off.sum()) < 1e-6 and not w[12:].any()


def test_calibration_finds_the_curve_scores_were_drawn_from():
    draw = np.random.default_rng(2)
    scores = draw.normal(0, 2, 60_000)
    good = (draw.random(60_000) < 1 / (1 + np.exp(-(0.7 * scores - 1)))) * 1.0
    slope, shift = quality.calibrated(scores, good, np.full(60_000, 1 / 60_000))
    assert abs(slope - 0.7) < 0.03 and abs(shift + 1) < 0.05


def labelled(n, first=0):
    """Every fourth text is marked by symbols after its words, or has lines in capitals."""
    docs, labels = [], []
    for k in range(first, first + n):
        text, bad = prose(60, k), k % 4 == 0
        if bad:
            text = text.replace(" ", "### ") if k % 8 else "\n".join(x.upper() + "!!" for x in text.split())
        docs.append((k, text, "en", "s", 0))
        labels.append((k, int(not bad), 0))
    return docs, labels


def test_held_out_labels(spark):
    docs, labels = labelled(800)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    known = spark.createDataFrame([r for r in labels if r[0] < 500], LABELS)
    out = {r["doc_id"]: r for r in quality.with_quality(frame, known).collect()}
    rest = [r for r in labels if r[0] >= 500]
    assert sum(out[k]["kept"] == bool(q) for k, q, _ in rest) >= 0.98 * len(rest)
    assert not any(out[k]["base_failed"] for k, _, _ in rest)
    # fewer rows of the frequent class than there are: probabilities stay those of all labelled rows
    few = quality.with_quality(frame, known, per_class=80).collect()
    assert sum(r["kept"] == bool(labels[r["doc_id"]][1]) for r in few) >= 0.95 * len(few)
    assert abs(np.mean([r["p_good"] for r in few]) - 0.75) < 0.1


def test_verdict_follows_the_rules(spark, edge_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 1, None), (9, None, 0), (None, 1, 1), (77, 0, 0)], LABELS)
    rows = quality.with_quality(edge_docs, labels.selectExpr("*", "'x' AS good", "'x' AS text")).collect()
    texts = Counter((r["doc_id"], counts_by_hand(r["text"])) for r in edge_docs.collect())
    assert Counter((r["doc_id"], tuple(r)[1:6]) for r in rows) == texts
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["p_good"] >= quality.KEEP)


@pytest.mark.parametrize("labels, p", [([], 1.0), ([(1, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_labels_of_one_class(spark, frame, labels, p):
    rows = quality.with_quality(frame([prose(40, 1), prose(50, 2)]), spark.createDataFrame(labels, LABELS)).collect()
    assert [abs(r["p_good"] - p) < 1e-9 for r in rows] == [True, True]


def test_lowest_label_and_one_text_of_repeated_rows(spark, frame):
    docs = frame(["b", "a", "a"]).selectExpr("IF(doc_id > 1, 1, doc_id) AS doc_id", "text")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (0, 1, 0), (8, 1, 0)], LABELS)
    rows = sorted((r["doc_id"], r["good"], r["text"]) for r in quality.labelled_sample(docs, labels).collect())
    assert rows == [(0, 1, "b"), (1, 0, "a")]


def test_empty_table(spark, empty_docs):
    assert quality.with_quality(empty_docs, spark.createDataFrame([], LABELS)).collect() == []
