import random

import numpy as np
import pytest

from grantlens.llm import toxicity

WORDS = [f"{a}{b}{c}" for a in ("tal", "mer", "sin") for b in ("do", "ka", "ri") for c in ("n", "sto", "ve")]
INSULTS = ["grobnik", "schmutzfink"]


def rows(n=900):
    draw = random.Random(7)
    docs, labels = [], []
    for k in range(n):
        words = draw.choices(WORDS, k=draw.randint(5, 60))
        toxic = k % 6 == 0
        if toxic:
            for _ in range(draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS) + draw.choice(["", ",", "s"]))
        docs.append((k, " ".join(words), "en", "s", 0))
        if k % 2 == 0:
            labels.append((k, k % 4 // 2, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = rows()
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_unlabelled_documents_are_told_apart(tables):
    found = {r["doc_id"]: r for r in toxicity.graded(*tables).collect()}
    odd = [k for k in found if k % 2]
    assert all(not found[k]["toxic"] for k in odd)  # toxic ones have even numbers here
    assert sum(found[k]["toxic"] for k in found if k % 6 == 0) / (len(found) / 6) > 0.97
    assert all(0 <= r["severity"] <= 2 and r["severity"] >= r["p_toxic"] for r in found.values())


def test_gradient_is_that_of_the_likelihood():
    draw = np.random.default_rng(3)
    held = [np.flatnonzero(draw.random(6) < 0.4) for _ in range(400)]
    grades = np.array([min(2, int(1 in h) + int(2 in h)) for h in held])
    model = toxicity.fit_arrays(held, grades)

    def loss(weights, thresholds):
        above = toxicity.exceedances(np.array([weights[h].sum() for h in held]), thresholds)
        edges = np.column_stack([np.ones(len(held)), above, np.zeros(len(held))])
        k = np.arange(len(held))
        return -np.log(np.maximum(edges[k, grades] - edges[k, grades + 1], 1e-12)).mean()

    best = loss(model.weights, model.thresholds)
    assert best < 0.1 and (np.diff(model.thresholds) > 0).all()
    assert model.weights[1] > 2 and model.weights[2] > 2 and model.weights[[0, 3, 4, 5]].max() < 1


def test_a_row_that_stands_for_others_counts_as_they_do():
    draw = np.random.default_rng(4)
    held = [np.flatnonzero(draw.random(6) < 0.4) for _ in range(200)]
    grades = np.array([min(2, int(1 in h) + int(draw.random() < 0.3)) for h in held])
    times = np.where(grades == 0, 4, 1)
    repeated = toxicity.fit_arrays([h for h, n in zip(held, times, strict=True) for _ in range(n)], np.repeat(grades, times))
    weighted = toxicity.fit_arrays(held, grades, stands_for=times.astype(float))
    assert np.allclose(repeated.weights, weighted.weights, atol=1e-3)
    assert np.allclose(repeated.thresholds, weighted.thresholds, atol=1e-3)


def test_predictions_hold_when_clean_rows_are_cut(spark):
    draw = random.Random(10)
    docs, labels = [], []
    for k in range(3000):
        toxic = k % 10 == 0
        words = draw.choices(WORDS, k=30)
        if toxic and k % 20 == 0:
            words[3] = INSULTS[0]
        if draw.random() < (0.4 if toxic else 0.03):  # a weak sign: of its texts, 60% are toxic
            words[7] = "wobaluk"
        docs.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    texts = [" ".join(WORDS[:20]), f"tal mer {INSULTS[0]} sin"]
    whole, cut = (toxicity.severities(texts, toxicity.fit(docs, labels, n))["p_toxic"] for n in (4000, 300))
    assert abs(whole[0] - cut[0]) < 0.03 and whole[1] > 0.9 and cut[1] > 0.9
    sample = toxicity.graded_sample(docs, labels, 300)
    assert {(r[0], r[1]) for r in sample.groupBy("grade").sum("stands_for").collect()} == {(0, 2700.0), (1, 300.0)}


def test_features_stay_within_their_text():
    own = [set(h.tolist()) for h in toxicity.held_features(["idiot x", "y idiot", "", None, "idiot"])]
    assert own[2] == own[3] == set() and own[4] <= own[0] & own[1]
    assert toxicity.held_features([]) == []


def test_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = "some words and more " * 200
    whole = toxicity.held_features([text])[0]
    monkeypatch.setattr(toxicity, "CHUNK", 31)
    assert (whole == toxicity.held_features([text])[0]).all()


def test_edges(edge_docs, tables, spark):
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 1), (8, None, 0), (9, 1, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.graded(edge_docs, labels).count() == edge_docs.count()
    none = labels.where("false")
    assert not any(r["toxic"] for r in toxicity.graded(edge_docs, none).collect())


def test_empty(empty_docs, tables):
    assert toxicity.graded(empty_docs, tables[1]).count() == 0
