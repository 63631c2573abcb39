import random
import zlib

import numpy as np

from grantlens.llm import language

SYLLABLES = {"en": ["the", "ing", "er", "an"], "de": ["sch", "en", "ung", "ö"], "fr": ["eau", "é", "oi", "ç"]}


def text(lang, words, draw):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(words))


def rows(n):
    draw = random.Random(6)
    out = []
    for k in range(n):
        lang = draw.choice(list(SYLLABLES))
        out.append((k, text(lang, draw.randint(3, 80), draw), lang if k % 7 else None, "s", 0))
    return out


def test_held_out_documents_are_recognised(spark):
    data = rows(600)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r for r in language.identified(docs).collect()}
    truth = {r[0]: r[2] for r in data}
    assert all(found[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in found)
    held = [k for k in found if found[k]["held_out"] and truth[k]]
    assert sum(found[k]["lang_pred"] == truth[k] for k in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())
    # neither the language nor the source of a document has a say in its prediction
    moved = spark.createDataFrame([(r[0], r[1], "fr" if found[r[0]]["held_out"] else r[2], "t", 1) for r in data], docs.schema)
    again = {r["doc_id"]: r["lang_pred"] for r in language.identified(moved).collect()}
    assert again == {k: r["lang_pred"] for k, r in found.items()}


def test_far_texts_are_rejected(spark):
    docs = spark.createDataFrame(rows(300) + [(1000, "qqqq zzzz xxxx " * 9, None, "s", 0), (1001, "12 34", "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in language.accepted(docs).collect()}
    assert kept == set(range(300))


ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "".join(map(chr, range(0x430, 0x450))),
             "arabic": "".join(map(chr, range(0x627, 0x64A))), "cjk": "".join(map(chr, range(0x4E00, 0x5E00)))}


def test_strange_texts_of_every_length_are_rejected(spark):
    draw = random.Random(8)
    strange = [" ".join("".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(words))
               for alphabet in ALPHABETS.values() for words in (5, 20, 100, 400, 1000, 5000)]
    usual = [(2000 + k, text(lang, words, draw), None, "s", 0)
             for k, (lang, words) in enumerate((x, n) for x in SYLLABLES for n in (5, 20, 400, 5000))]
    data = rows(600)
    docs = spark.createDataFrame(data + usual + [(1000 + k, t, None, "s", 0) for k, t in enumerate(strange)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in language.accepted(docs).collect()}
    assert kept == {r[0] for r in data + usual}


def test_grams_do_not_depend_on_chunks(monkeypatch):
    whole = language.gram_counts("Some words, and OTHERS — äöü. " * 50)
    monkeypatch.setattr(language, "CHUNK", 37)
    assert (whole == language.gram_counts("Some words, and OTHERS — äöü. " * 50)).all()


def test_clusters():
    draw = np.random.default_rng(1)
    centre = np.eye(8)[[0, 3]]
    points = np.repeat(centre, 50, axis=0) + draw.normal(0, 0.05, (100, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    assert (language.clustered(points, 2) @ centre.T).max(axis=0).min() > 0.99
    assert len(language.clustered(points[:1], 3)) == 1


def spread(centres, sizes, odd, dims=60):
    """Points around each centre, and ``odd`` single ones that are near to nothing."""
    draw = np.random.default_rng(2)
    points = np.vstack([np.eye(dims)[[c]] + draw.normal(0, 0.05, (n, dims)) for c, n in zip(centres, sizes, strict=True)]
                       + [np.eye(dims)[dims - odd:]])
    return (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)


def test_odd_texts_leave_every_variety_its_centre():
    for sizes in ((200, 190), (300, 90), (380, 12)):
        points = spread((0, 3), sizes, 6)
        found = language.clustered(points, 3)
        assert (found @ np.eye(60)[[0, 3]].T).max(axis=0).min() > 0.9 and len(found) <= 3
    one = language.clustered(spread((0,), (300,), 3), 3)
    assert len(one) == 3 and (one @ np.eye(60)[0]).min() > 0.5  # several centres of one cloud, none of them a stray


def test_a_language_of_two_varieties_keeps_two_centroids(spark):
    draw = random.Random(9)
    data = [(k, text("de" if k % 2 else "fr", 40, draw), "xx", "s", 0) for k in range(200)]
    data += [(1000 + k, odd, "xx", "s", 0) for k, odd in enumerate(["A.", "+1 (132) 555 und.34@mail7.example.com", "Qx", "zzz"])]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.fit(docs)
    near = np.array([language.predict([text(v, 60, draw)], model)["score"][0] for v in ("de", "fr")])
    assert len(model.owner) >= 2 and near.min() > 0.7
    place = [language.gram_counts(text(v, 60, draw))[0] for v in ("de", "fr")]
    best = [model.centroids[np.isin(model.grams, p)].sum(axis=0).argmax() for p in place]
    assert best[0] != best[1]


def test_edges(edge_docs):
    found = language.identified(edge_docs).collect()
    assert len(found) == edge_docs.count()
    unknown = {r["doc_id"] for r in found if r["lang_pred"] == "und" and r["doc_id"] is not None}
    assert unknown == {1, 2, 3, 10} and all(r["score"] == 0 for r in found if r["doc_id"] in unknown)
    assert language.accepted(edge_docs).columns == edge_docs.columns


def test_nothing_to_learn_from(frame, empty_docs):
    found = language.identified(frame(["some text"]).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert [r["lang_pred"] for r in found] == ["und"]
    assert language.identified(empty_docs).count() == 0 and language.accepted(empty_docs).count() == 0
