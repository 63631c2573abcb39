import random

import numpy as np
import pytest
from brute_force import least_reachable

from grantlens.llm import minhash
from grantlens.llm.components import components

def near_copies():
    """Groups of copies with more and fewer changes, texts with a common passage, chains."""
    draw = random.Random(8)
    word = lambda: f"w{draw.randrange(10**6)}"
    out = [None, "", "  ", "A b", "a B", "a b c d", "a b c d e", "x " * 50, "X " * 60]
    for changes in (0, 2, 4, 7):
        base = [word() for _ in range(160)]
        for _ in range(40):
            copy = list(base)
            for _ in range(draw.randint(0, changes)):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    passage = [word() for _ in range(60)]
    out += [" ".join([*passage, *(word() for _ in range(n))]) for n in (5, 10, 20, 30, 40, 60) for _ in range(12)]
    chain = [word() for _ in range(200)]
    out += [" ".join(chain[k:k + 100]) for k in range(0, 100, 10)]
    return out


@pytest.fixture(scope="module")
def found(frame):
    return minhash.with_components(frame(near_copies())).orderBy("doc_id").collect()


def test_components_equal_those_of_all_pairs(found):
    want, sizes = least_reachable(near_copies())
    assert [r["component_id"] for r in found] == want
    assert [r["n_shingles"] for r in found] == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_blocks_of_a_bucket_meet_each_other(spark, frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    texts = near_copies()[9:89] + near_copies()[-20:]
    got = minhash.with_components(frame(texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == least_reachable(texts)[0]


def test_all_pairs_of_a_bucket(spark, monkeypatch):
    draw = np.random.default_rng(1)
    sig = draw.integers(0, 2**32, minhash.BANDS * minhash.ROWS).astype(np.uint32)
    apart = np.concatenate([sig[:8], ~sig[8:]])
    first, second = minhash.band_keys(sig)[:2].tolist()
    rows = [(k, k // 2, 100, sig) for k in range(30)] + [(98, 98, 60, sig), (99, 99, 100, apart)]
    sketches = spark.createDataFrame(
        [(tid, n, minhash.sketch(s), s.tobytes()) for tid, _, n, s in rows], "tid long, n long, sketch binary, signature binary")
    want = {(a, b) for a in range(30) for b in range(a + 1, 30) if a // 2 != b // 2}
    for block, small in ((4096, 64), (4096, 2), (4, 2)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "SMALL", small)
        members = [(bucket, band, tid, label, len(rows)) for band, bucket in enumerate((first, second)) for tid, label, _, _ in rows]
        divided = spark.createDataFrame(members, "bucket long, band int, tid long, label long, size long")
        # pairs belong to the first bucket they share
        got = [tuple(r) for r in minhash._looked_at(divided, sketches, minhash._every, minhash._PAIRS).collect()]
        assert len(got) == len(want) and set(got) == want
        near = minhash._looked_at(divided, sketches, minhash._nearest, minhash._NEAR).collect()
        assert {r["tid"] for r in near} == set(range(30)) and all(r["tid"] // 2 != r["other"] // 2 for r in near)


def test_pairs_that_are_not_linked_make_no_rows(spark, frame, monkeypatch):
    """A large group of texts that are alike, but for the most part not enough: pairs would grow with its square."""
    draw = random.Random(4)
    word = lambda: f"w{draw.randrange(10**6)}"
    base, texts = [word() for _ in range(100)], []
    for _ in range(150):
        copy = list(base)
        for k in draw.sample(range(100), draw.choice([1, 2, 3])):
            copy[k] = word()
        texts.append(" ".join(copy))
    made, compared, looked = [], minhash.linked, minhash._looked_at
    monkeypatch.setattr(minhash, "NEAREST_TURNS", 1)
    monkeypatch.setattr(minhash, "linked", lambda pairs, rows: made.append(pairs.count()) or compared(pairs, rows))

    def counted(divided, sketches, look, *rest):
        out = looked(divided, sketches, look, *rest)
        if look is not minhash._nearest:
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_looked_at", counted)
    want = least_reachable(texts)[0]
    for block, parts in ((4096, 1000), (20, 1000), (4096, 4)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "SET_PARTS", parts)
        got = minhash.with_components(frame(texts)).orderBy("doc_id").collect()
        assert [r["component_id"] for r in got] == want and len(set(want)) > 1
    assert max(made) <= minhash.PAIRS_A_ROW * len(texts)


def test_signatures_estimate_likeness():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 2**63, 1400).astype(np.uint64)
    a, b = minhash.signature(np.unique(values[:1200])), minhash.signature(np.unique(values[200:]))
    assert abs((a == b).mean() - 1000 / 1400) < 0.15
    assert (minhash.signature(values) == minhash.signature(values[::-1])).all()


def test_edges(edge_docs):
    rows = minhash.with_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == 1 and by_id[1]["n_shingles"] == 0 and by_id[1]["kept"]
    assert {r["component_id"] for r in rows if r["doc_id"] == 4} == {4}
    assert sorted(r["component_id"] for r in rows if r["doc_id"] == 5) == [4, 5]
    assert all(r["component_id"] is None and not r["kept"] for r in rows if r["doc_id"] is None)


def test_one_row_of_each_group_stays(edge_docs):
    kept = minhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([None, None, 1, 2, 3, 4, 5, -6, 7, 8, 9, 10, 9_000_000_000_000_000_000], key=str)


def test_empty(empty_docs):
    assert minhash.with_components(empty_docs).count() == 0
    assert minhash.one_of_each(empty_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_divided_buckets_are_found_without_a_join_of_buckets(spark):
    """A row comes out once at most, however many rows its bucket has."""
    members = spark.createDataFrame([(1, 0, t) for t in range(50)] + [(2, 1, 0), (2, 1, 1), (3, 2, 2), (3, 2, 3)], "bucket long, band int, tid long")
    labels = spark.createDataFrame([(t, t // 2) for t in range(50)], "tid long, label long")
    found = minhash._divided(members, labels)
    assert sorted(r["tid"] for r in found.collect()) == list(range(50))
    assert {(r["bucket"], r["size"]) for r in found.collect()} == {(1, 50)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join [tid" in plan and "Join [bucket" not in plan
