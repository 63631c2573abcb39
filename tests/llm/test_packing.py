import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grantlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_one_by_one_give_the_ids_of_the_text(tokenizer):
    coder = packing.WordCoder(PATH)
    for text in ["Don't I'LL É́cole ΣΑΣ. x<|endoftext|>y <|ENDOFTEXT|> 12a.b, a.,b -- ...", "İstanbul ß ﬁ ǅ ⅷ KK a\x1cb 漢字、かな",
                 "", " \n", "<|startoftext|>Hello, World.", "é, É. ñ.. a,. 1. ²,", "a b", "WORD word Word, word. word.,"]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("ways", [1, 2, 3, 7])
def test_differencing_deals_all_sizes_evenly(ways):
    sizes = np.random.default_rng(ways).integers(1, 100, 200)
    loads = np.bincount(packing.differencing(sizes, ways), weights=sizes, minlength=ways)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() <= 3


def test_differencing_small():
    assert packing.differencing(np.array([8, 7, 6, 5, 4]), 2).tolist() in ([0, 1, 1, 0, 0], [1, 0, 0, 1, 1])
    assert packing.differencing(np.zeros(0, np.int64), 3).tolist() == []


def test_window_count_rises_until_nothing_overflows():
    sizes = np.array([60, 60, 60])
    assert len(set(packing.pack_sizes(sizes, 100).tolist())) == 3


def check_pieces(pieces, texts, tokenizer, capacity):
    """Every id in one piece, pieces in order, sequences gapless and not too long."""
    by_sequence, by_text = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        by_text.setdefault(p["doc_id"], []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(by_text[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    return len(by_sequence)


def test_pack(spark, frame, tokenizer):
    draw = np.random.default_rng(3)
    texts = {k: "some words, and more " * int(draw.integers(0, 60)) for k in range(120)}
    pieces = packing.pack(frame(list(texts.values())), PATH, capacity=128, piece=16, block_tokens=2000).collect()
    used = check_pieces(pieces, texts, tokenizer, 128)
    tokens = sum(p["length"] for p in pieces)
    assert tokens / (128 * used) > 0.93


def test_edges(edge_docs, tokenizer):
    pieces = packing.pack(edge_docs, PATH).collect()
    alone = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] not in (None, 4, 5)}
    check_pieces(pieces, alone, tokenizer, packing.CAPACITY)
    assert sum(p["start"] == 0 for p in pieces) == edge_docs.count()
    assert sum(p["doc_tokens"] == 1 for p in pieces) == 4  # null, null, empty, blank


def test_empty(empty_docs):
    assert packing.pack(empty_docs, PATH).count() == 0


def test_few_words_are_encoded_without_threads_of_their_own():
    """A batch of few words wakes a thread on every core; ids equal those of whole texts, with signs beyond ASCII too."""
    coder = packing.WordCoder(PATH)
    whole = coder.tokenizer

    class Plain:
        model = whole.model

        def encode(self, text, **options):
            return whole.encode(text, **options)

    coder.tokenizer = Plain()  # has no encode_batch
    for text in ("one two, ünder 12-34 Über ﬁne x.y É é <|a|> A", "naïve 漢字 \U0001F600 it's UPPER lower.", ""):
        want = np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert coder.encode(text) == want == coder.encode(text)
