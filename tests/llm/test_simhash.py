import hashlib
import random
from itertools import combinations

import pytest

from grantlens.llm import simhash


def test_fingerprints_of_edited_texts(frame):
    draw = random.Random(4)
    texts = [" ".join(f"w{draw.randrange(500)}\U0001F600" for _ in range(draw.randint(0, 300))) for _ in range(60)]
    texts[7] = texts[20] = texts[3]
    for rows in (5, 5000):
        found = simhash.fingerprints(frame(texts, first=10), rows=rows).orderBy("doc_id").collect()
        for k, (row, text) in enumerate(zip(found, texts, strict=True)):
            half, following = len(text) // 2, texts[(k + 1) % len(texts)]
            edited = text[:len(text) - half] + following[:half]
            assert row["n_chars"] == len(text)
            assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert row["near_next"] == likeness(row["fingerprint"], found[(k + 1) % len(texts)]["fingerprint"])
            assert row["near_edited"] == likeness(row["fingerprint"], row["edited_fingerprint"])
        assert found[3]["fingerprint"] == found[7]["fingerprint"] == found[20]["fingerprint"]
        longer = [r for r in found if r["n_chars"] > 600]
        assert sum(r["near_edited"] > r["near_next"] for r in longer) / len(longer) > 0.9


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def test_block_tables_find_all_within_the_radius(spark):
    draw = random.Random(5)
    prints = [draw.getrandbits(128) for _ in range(20)]
    prints += [p ^ sum(1 << draw.randrange(128) for _ in range(draw.randint(1, 5))) for p in prints * 4]
    prints = [f"{p % (1 << 128):032x}" for p in prints]
    frame = spark.createDataFrame([(p,) for p in prints + prints[:5]], "fingerprint string")
    for radius in (0, 1, 3):
        want = {(a, b, d) for a, b in combinations(sorted(set(prints)), 2)
                if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= radius}
        got = simhash.near_pairs(frame, radius).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    with pytest.raises(ValueError):
        simhash.near_pairs(frame, 6)


def test_edges(edge_docs):
    rows = simhash.fingerprints(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"0" * 32}
    assert all(len(r["fingerprint"]) == 32 and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_one_document_is_its_own_next(frame):
    row = simhash.fingerprints(frame(["abcde"])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcab").hexdigest() and row["near_next"] == 1


def test_empty(empty_docs):
    assert simhash.fingerprints(empty_docs).count() == 0
