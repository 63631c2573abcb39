import random

import numpy as np
import pytest

from grantlens.llm import hashing


@pytest.mark.parametrize("length", [1, 2, 3, 5, 15, 35, 64, 400])
def test_windows_are_equal_where_their_values_are(length):
    values = hashing.mixed(np.random.default_rng(length).integers(0, 3, 2000).astype(np.uint64))
    found = hashing.windows(values, length)
    assert len(found) == len(values) - length + 1
    by_content = {}
    for k, h in enumerate(found.tolist()):
        by_content.setdefault(values[k:k + length].tobytes(), set()).add(h)
    assert all(len(x) == 1 for x in by_content.values())
    assert len(set.union(*by_content.values())) == len(by_content)


def test_words_are_those_that_blanks_separate(monkeypatch):
    draw = random.Random(1)
    raw = bytes(draw.choice(b"ab \n\t\x0b\x0c\r\x1c\xc3\xa9") for _ in range(5000))
    for chunk in (1 << 20, 64):
        monkeypatch.setattr(hashing, "CHUNK", chunk)
        hashes, starts, ends = hashing.word_tokens(raw)
        words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        assert words == raw.split()
        assert len(set(hashes.tolist())) == len(set(words))


def test_tokens_of_several_texts():
    texts = [b"Hello  world", b"", b" world\x0bb"]
    tokens = hashing.tokens_of(texts)
    assert tokens.bounds.tolist() == [0, 2, 2, 4]
    assert tokens.hashes[1] == tokens.hashes[2] != tokens.hashes[3]


def test_no_values():
    assert len(hashing.windows(np.zeros(0, np.uint64), 5)) == 0
    assert all(len(x) == 0 for x in hashing.word_tokens(b""))
