"""Alignments against whole-text encodings, decoded bytes and plain loops; exact round trips."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute_force import prose
from grantlens.llm import alignment
from grantlens.llm.alignment import Aligned

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# What tokenizers treat in ways of their own.
PARTS = ["a", "B", " ", " ", "  ", "\n", "\t", "é", "漢", "\U0001F600", "▁", "'s", "'", "1", "23", ".", "!?", "\x00", "\x1c",
         "<s>", "<|endoftext|>", "<0x41>", "ing", "the", "ﬁ", "́", "‍", "﻿", "\xa0", "Ω"]


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner(A, B)


def plainly(own, text):
    """Ends from decoded bytes of one encoding of the whole text; None where the bytes differ."""
    raw = (" " + (text or "")).encode()
    a, b = own.a.encode(" " + (text or ""), add_special_tokens=False).ids, own.b.encode(text or "")
    left, right = [own.a_bytes[i] for i in a], [own.b_bytes[i] for i in b]
    if not text or b"".join(left) != raw or b"".join(right) != raw:
        return None
    return Aligned(np.array(a), np.cumsum([len(x) for x in left]), np.array(b), np.cumsum([len(x) for x in right]))


def same(x, y):
    return x is y if x is None or y is None else all(np.array_equal(p, q) for p, q in zip(x, y, strict=True))


def texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(n)]


def test_spans_and_chunks_give_the_ends_of_whole_encodings(own):
    assert own.divisible
    for text in [*texts(1500, 1), prose(300, 1), prose(50, 2, "äß漢é"), "x" * 3000, "漢" * 500, "é ß\x0b漢字 " * 40]:
        assert same(own.whole(text), plainly(own, text)), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=30))
def test_any_text(own, text):
    assert same(own.whole(text), plainly(own, text))


def test_undivided_texts_give_the_same(own, monkeypatch):
    monkeypatch.setattr(own, "divisible", False)
    for text in texts(200, 2):
        assert same(own.whole(text), plainly(own, text)), repr(text)


def test_round_trip(own):
    for text in ["Hé 漢字\U0001F600 two\n words", prose(40, 3)]:
        found = own.whole(text)
        raw = (" " + text).encode()
        for ids, ends, decoded in ((found.a, found.a_ends, own.a_bytes), (found.b, found.b_ends, own.b_bytes)):
            assert [raw[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)] == [decoded[i] for i in ids]


def links_by_hand(found):
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in (found.a_ends.tolist(), found.b_ends.tolist())]
    return [(int(found.a[i]), int(found.b[j])) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]


def groups_by_hand(found):
    common = sorted(set(found.a_ends.tolist()) & set(found.b_ends.tolist()))
    out, low = [], 0
    for high in common:
        sides = [",".join(str(i) for i, e in zip(ids, ends, strict=True) if low < e <= high)
                 for ids, ends in ((found.a, found.a_ends), (found.b, found.b_ends))]
        out.append("|".join(sides))
        low = high
    return ";".join(out)


def digests_by_hand(own, rows):
    links = [Counter(links_by_hand(f)) if (f := plainly(own, t)) else Counter() for _, t in rows]
    held = Counter(pair for c in links for pair in c)
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, text), c in zip(rows, links, strict=True):
        f = plainly(own, text)
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        written = groups_by_hand(f)
        out.append((doc_id, len(f.a), len(f.b), written.count(";") + 1, c.total(), sum(n for p, n in c.items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in c.items()), hashlib.sha256(written.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def digests(docs):
    return sorted((tuple(r) for r in alignment.alignment_digests(docs, A, B).select(COLUMNS).collect()), key=repr)


def test_digests_equal_plain_loops(spark, own, monkeypatch, frame):
    monkeypatch.setattr(alignment, "CACHED", 20)
    rows = texts(120, 3) + [prose(30, k) for k in range(30)] * 2 + [None, "", " ", "▁", "a▁b"]
    docs = frame(rows)
    assert digests(docs) == digests_by_hand(own, list(enumerate(rows)))


def test_pairs_meet_across_small_slices(spark, own, monkeypatch, frame):
    rows = [prose(20, k % 7, "abc") for k in range(60)]
    docs = frame(rows)
    # the workers import the module anew: slices of a few rows come from the settings the function closes over
    few = alignment.sliced(docs, A, B, size=300)
    assert few.where("pairs IS NOT NULL").count() > 10
    monkeypatch.setattr(alignment, "SLICE", 300)
    assert digests(docs) == digests_by_hand(own, list(enumerate(rows)))


def test_edge_rows(own, edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    short = [(k, t) for k, t in rows if len(t or "") < 10_000]
    found = digests(edge_docs.where("length(coalesce(text, '')) < 10000"))
    assert found == digests_by_hand(own, short)
    whole = {r[0]: r for r in digests(edge_docs)}
    assert whole[7][1:3] == tuple(len(x) for x in (plainly(own, "x" * 300_000).a, plainly(own, "x" * 300_000).b))


def test_general_output(own, frame):
    rows = [prose(30, 5), None, "漢字 é\n ok"]
    for r in alignment.aligned(frame(rows), A, B).collect():
        want = plainly(own, rows[r["doc_id"]])
        if want is None:
            assert r["a_ids"] == r["b_groups"] == []
            continue
        assert [r["a_ids"], r["a_ends"], r["b_ids"], r["b_ends"]] == [x.tolist() for x in want]
        assert [r["a_ends"][k - 1] for k in r["a_groups"]] == [r["b_ends"][k - 1] for k in r["b_groups"]]


def test_empty_table(empty_docs):
    assert digests(empty_docs) == []
