"""Both removers of repeated content against counting all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from grantlens.llm import substring, suffix
from grantlens.llm.repeats import merged, places

WORDS, BYTES = 35, 400


def gone(units, length, counts):
    flags = [False] * len(units)
    for k in range(len(units) - length + 1):
        if counts[tuple(units[k:k + length])] > 1:
            flags[k:k + length] = [True] * length
    return flags


def counted(sequences, length):
    return Counter(tuple(s[k:k + length]) for s in sequences for k in range(len(s) - length + 1))


def without_words(texts):
    split = [(t or "").encode().split() for t in texts]
    counts = counted(split, WORDS)
    for words in split:
        flags = gone(words, WORDS, counts)
        kept = b" ".join(w for w, f in zip(words, flags, strict=True) if not f)
        yield len(words), sum(flags), hashlib.sha256(kept).hexdigest()


def without_bytes(texts):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[k:k + BYTES] for r in raws for k in range(len(r) - BYTES + 1))
    for raw in raws:
        flags = [False] * len(raw)
        for k in range(len(raw) - BYTES + 1):
            if counts[raw[k:k + BYTES]] > 1:
                flags[k:k + BYTES] = [True] * BYTES
        spans = sum(f and not before for f, before in zip(flags, [False, *flags], strict=False))
        kept = bytes(b for b, f in zip(raw, flags, strict=True) if not f)
        yield len(raw), sum(flags), spans, hashlib.sha256(kept).hexdigest()


def texts():
    draw = random.Random(5)
    base = [" ".join(draw.choice(["ab", "c", "de", "f"]) for _ in range(90)) for _ in range(4)]
    other = [" ".join(str(draw.randrange(10**6)) for _ in range(120)) for _ in range(3)]
    passage = " ".join(str(draw.randrange(10**6)) for _ in range(70))
    shared = [f"{k} {k * k} {passage[:-k]} {k * 7}" for k in range(1, 40)]  # a passage in many surroundings
    ties = [" ".join(draw.choice("ab") for _ in range(draw.randint(1, 120))) for _ in range(30)]
    return [
        None, "", "x", " \n ", *base, *other, base[0], f"{base[1]} zz {base[2]}", "a " * 200, "a " * 40, "b a " * 70,
        f"{base[3][:150]} q {base[3][30:]}", *shared, *ties, ("x" * 37 + "y") * 30, "z" * 2000, "z" * 399, "z" * 400,
        "é" * 300, other[0][3:] + other[1],
    ]


@pytest.fixture(scope="module")
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_words_are_removed_as_by_counting(frame, small_batches):
    found = substring.without_repeats(frame(texts())).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found] == list(without_words(texts()))


@pytest.mark.parametrize("group_limit", [2, 2000])
def test_bytes_are_removed_as_by_counting(frame, small_batches, group_limit):
    """With a limit of 2 nearly all groups are too large for a shard and are compared by blocks."""
    found = suffix.without_repeats(frame(texts()), group_limit=group_limit).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == list(without_bytes(texts()))


def test_difference_cover():
    shifts = {(p - q) % substring.PERIOD for p in substring.COVER for q in substring.COVER}
    assert shifts == set(range(substring.PERIOD))


def test_longest_previous_factors():
    text = b"abracadabra-abracadabra-cadab"
    width = len(text)
    padded = [text[k:].ljust(width, bytes([k])) for k in range(width)]  # ends differ
    earlier, later = suffix.matches(padded, np.arange(width))

    def shared(i, j):
        return next((n for n in range(width) if padded[i][n] != padded[j][n]), width)

    assert earlier.tolist() == [max((shared(i, j) for j in range(i)), default=0) for i in range(width)]
    assert later.tolist() == [max((shared(i, j) for j in range(i + 1, width)), default=0) for i in range(width)]


def test_anchors_are_leftmost_and_the_same_in_chunks():
    values = np.array([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9] * 20, np.uint64) << np.uint64(40)
    whole = suffix.anchors(values, 12, 5)
    assert (whole == suffix.anchors(values, 12, 5, step=10)).all()
    assert ((whole >= np.arange(len(whole))) & (whole <= np.arange(len(whole)) + 7)).all()


def test_runs():
    tid, a, b = merged(np.array([2, 1, 1, 1]), np.array([0, 5, 0, 3]), np.array([1, 9, 2, 5]))
    assert list(zip(tid.tolist(), a.tolist(), b.tolist(), strict=True)) == [(1, 0, 9), (2, 0, 1)]
    assert places(np.array([5, 1]), np.array([6, 2])).tolist() == [1, 2, 5, 6]


@pytest.mark.parametrize(("remove", "expected"), [(substring.without_repeats, without_words), (suffix.without_repeats, without_bytes)])
def test_edges(edge_docs, remove, expected):
    rows = edge_docs.select("doc_id", "text").collect()
    # the two texts of one long line are too long to count all of their strings
    want = sorted(str(x) for x in expected([r["text"] for r in rows if len(r["text"] or "") < 100_000]))
    got = [r for r in remove(edge_docs).collect() if r["doc_id"] not in (-6, 7)]
    assert sorted(str(tuple(r)[1:]) for r in got) == want


def test_one_long_line_repeats_itself(edge_docs):
    line = suffix.without_repeats(edge_docs).where("doc_id = 7").first()
    assert (line["n_bytes"], line["n_removed"], line["n_spans"]) == (300_000, 300_000, 1)


def test_texts_are_returned(frame):
    cut = suffix.cut_texts(frame(["a" * 500, "b"])).collect()
    assert sorted(bytes(r["kept"]) for r in cut) == [b"", b"b"]
    cut = substring.cut_texts(frame(["a  b"])).collect()
    assert [r["kept"] for r in cut] == ["a b"]


def test_empty(empty_docs):
    assert substring.without_repeats(empty_docs).count() == 0
    assert suffix.without_repeats(empty_docs).count() == 0


def test_anchors_are_handed_on_in_parts(monkeypatch):
    """A batch of texts is not held as one table; the parts hold the same anchors."""
    import pandas as pd

    from grantlens.llm import hashing, substring

    monkeypatch.setattr(hashing.grouped, "__defaults__", (2000,))
    texts = pd.DataFrame({"tid": range(60), "text": [" ".join(f"w{k}x{j}" for j in range(100)) for k in range(60)]})
    whole = pd.concat(substring._anchors(35)(iter([texts])))
    monkeypatch.setattr(substring, "AT_ONCE", 200)
    parts = list(substring._anchors(35)(iter([texts])))
    assert len(parts) > 3 and max(map(len, parts)) < len(whole) / 3
    columns = ["core", "full", "tid", "a", "b"]
    assert sorted(map(tuple, pd.concat(parts)[columns].to_numpy())) == sorted(map(tuple, whole[columns].to_numpy()))
