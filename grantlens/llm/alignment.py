"""Which tokens of two tokenizers cover the same bytes of a text.

A text with a blank before it is encoded by a byte-level BPE (A) and by a sentencepiece model (B). The spans both
libraries report are coarse cuts: characters for A, bytes of the text for B. A token that ends where its span ends and
the next one begins is placed by them; tokens that share a character, and pieces of single bytes, which have empty
spans, are placed inside their cut by the lengths of their decoded bytes. Offsets where tokens of both end cut
the tokens into groups; an A and a B token are linked if their bytes overlap.

Texts are encoded whole, in chunks at blanks where neither tokenizer can join what lies on both sides: a single blank
between two characters that are no white space, while no piece of B holds a blank after another character. The
alignments of chunks are kept, up to CACHED of them per task, so that a word costs one encoding.

``corpus_links`` counts in how many documents a pair of ids is linked. Tasks add up the documents of a slice of
a few megabytes, the counts meet by pair and go back to the slices that hold it, so a pair that every document holds is
a row per slice. Documents then look their links up inside their slice.

A text that is null or empty, or whose joined token bytes of A or B are not the blank and the text, has no
tokens. Repeated rows are documents of their own. Ties among the most frequent partners of an A id all count as best. An
empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import stored
from grantlens.llm.hashing import grouped

CACHED = 300_000  # chunks a task remembers
SLICE = 4 << 20  # bytes of text in a slice

_CUT = re.compile("(?<=[^\\s▁])(?= \\S)")


class Aligned(NamedTuple):
    """Ids of both tokenizers and the byte offsets where their tokens end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of A and of B lie before each common end."""
        _, in_a, in_b = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True, return_indices=True)
        return in_a + 1, in_b + 1

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b`` of all tokens whose bytes overlap."""
        first = np.searchsorted(self.b_ends, np.append(0, self.a_ends[:-1]), side="right")
        counts = np.searchsorted(self.b_ends, self.a_ends, side="left") - first + 1
        at_a = np.repeat(np.arange(len(self.a)), counts)
        within = np.arange(len(at_a)) - np.repeat(np.cumsum(counts) - counts, counts)
        return at_a, first[at_a] + within


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def refined(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes, from coarse spans in bytes and the lengths of the decoded tokens."""
    if not len(ends):
        return ends
    after = np.append(begins[1:], ends[-1])
    before = np.append(0, np.maximum.accumulate(ends)[:-1])
    cut = (ends > before) & (after >= ends)
    cut[-1] = True
    # inside a cut the lengths add up from where the cut before it ends
    total = np.cumsum(sizes)
    at = np.flatnonzero(cut)
    cell = np.searchsorted(at, np.arange(len(ends)))
    start, added = np.append(0, ends[at])[cell], np.append(0, total[at])[cell]
    return np.where(cut, ends, start + total - added)


def _split_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


class Aligner:
    """The two tokenizers, and what is known of the chunks seen last.

    A chunk is written without the blank that it begins with.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()
                        if all(c in alphabet for c in t)}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, dtype=np.int64)
        for i, decoded in self.a_bytes.items():
            self.a_sizes[i] = len(decoded)
        self.b_sizes = np.array([len(decoded) for decoded in self.b_bytes], dtype=np.int64)
        self.width = len(pieces)
        self.divisible = not any(re.search("[^▁]▁", p) for p in pieces)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.written: list[str] = []
        self.numbers = np.zeros((0, 3), dtype=np.int64)  # tokens of A, of B, groups; -1 without tokens
        self.bounds = np.zeros(1, dtype=np.int64)
        self.keys = np.zeros(0, dtype=np.int64)  # of the linked pairs of all chunks
        self.uses = np.zeros(0, dtype=np.int64)

    def _make_room(self) -> None:
        """Forget the chunks that were met once, or all if that is not enough."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > CACHED // 2:
            self._forget()
            return
        new = np.full(len(self.uses), -1)
        new[kept] = np.arange(len(kept))
        self.known = {c: int(new[k]) for c, k in self.known.items() if new[k] >= 0}
        self.written = [self.written[k] for k in kept.tolist()]
        links = np.diff(self.bounds)
        self.keys = self.keys[np.repeat(new >= 0, links)]
        self.bounds = np.concatenate([[0], np.cumsum(links[kept])])
        self.numbers, self.uses = self.numbers[kept], np.zeros(len(kept), dtype=np.int64)

    def chunks(self, text: str) -> list[str]:
        """Parts of the blank and ``text`` that can be encoded apart."""
        if not self.divisible:
            return [text]
        if " ".join(text.split()) == text.replace("\n", " ") and "▁" not in text:
            return text.split(" ")  # nowhere two kinds of white space side by side
        return [c[1:] for c in _CUT.split(" " + text)]

    def aligned(self, chunks: list[str]) -> tuple[Aligned, np.ndarray, np.ndarray, np.ndarray]:
        """The alignment of the chunks one after the other, tokens of A and of B in each, and which have tokens."""
        text = " " + " ".join(chunks) if chunks else ""
        raw = text.encode()
        encoded = self.a.encode_batch([" " + c for c in chunks], add_special_tokens=False)
        pieces = [x.pieces for x in self.b.encode(chunks, return_type="proto", num_threads=1)]
        fields = [(p.id, p.end) for x in pieces for p in x]
        in_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = [e.ids for e in encoded]
        in_a = np.fromiter(map(len, ids), np.int64, len(ids))
        a = list(chain.from_iterable(ids))
        b = [i for i, _ in fields]
        a_raw, b_raw = b"".join(map(self.a_bytes.__getitem__, a)), b"".join(map(self.b_bytes.__getitem__, b))
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_sizes, b_sizes = self.a_sizes[a], self.b_sizes[b]
        lengths = np.array([len(c) + 1 for c in chunks], dtype=np.int64)
        sizes = np.array([len(c.encode()) + 1 for c in chunks], dtype=np.int64)
        whole = np.ones(len(chunks), dtype=bool)
        if a_raw != raw or b_raw != raw:
            for side, counts, decoded in ((a, in_a, self.a_bytes), (b, in_b, self.b_bytes)):
                at = np.cumsum([0, *counts])
                for k, c in enumerate(chunks):
                    whole[k] &= b"".join(decoded[i] for i in side[at[k]:at[k + 1]]) == (" " + c).encode()
        else:
            for counts, side in ((in_a, a_sizes), (in_b, b_sizes)):
                whole &= _split_sums(side, np.cumsum([0, *counts])) == sizes
        if not whole.all():
            found, some_a, some_b, _ = self.aligned([c for c, ok in zip(chunks, whole, strict=True) if ok])
            in_a, in_b = np.zeros_like(in_a), np.zeros_like(in_b)
            in_a[whole], in_b[whole] = some_a, some_b
            return found, in_a, in_b, whole

        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in encoded)), np.int64, 2 * len(a)).reshape(-1, 2)
        spans = spans + np.repeat(np.cumsum(lengths) - lengths, in_a)[:, None]
        if len(raw) != len(text):  # characters to bytes
            lead = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
            spans = np.append(np.flatnonzero(lead), len(raw))[spans]
        a_ends = refined(spans[:, 0], spans[:, 1], a_sizes)
        ends = np.fromiter((e for _, e in fields), np.int64, len(b))
        # spans of B follow each other; the blank before the text is the first piece's
        ends = np.where(ends > 0, ends + 1, 0) + np.repeat(np.cumsum(sizes) - sizes, in_b)
        b_ends = refined(np.append(0, ends[:-1])[:len(b)], ends, b_sizes)
        return Aligned(a, a_ends, b, b_ends), in_a, in_b, whole

    def whole(self, text: str | None) -> Aligned | None:
        """The alignment of a text; ends are offsets in the blank and the text."""
        if not text:
            return None
        found, _, _, whole = self.aligned(self.chunks(text))
        return found if whole.all() else None

    def _learn(self, chunks: list[str]) -> None:
        found, in_a, in_b, whole = self.aligned(chunks)
        to_a, to_b = found.groups()
        group_a = np.searchsorted(to_a, np.arange(len(found.a)), side="right")
        group_b = np.searchsorted(to_b, np.arange(len(found.b)), side="right")
        last_a, last_b = np.zeros(len(found.a), bool), np.zeros(len(found.b), bool)
        last_a[to_a - 1], last_b[to_b - 1] = True, True
        ends = np.concatenate([np.where(last_a, "|", ","), np.where(last_b, ";", ",")]).tolist()
        signs = [f"{i}{end}" for i, end in zip(chain(found.a.tolist(), found.b.tolist()), ends, strict=True)]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable").tolist()
        signs = [signs[k] for k in order]  # a group's tokens of A, then those of B
        bounds_a, bounds = np.cumsum([0, *in_a]), np.cumsum([0, *(in_a + in_b)]).tolist()
        at_a, at_b = found.links()
        links = np.diff(np.searchsorted(at_a, bounds_a))
        groups = np.diff(np.searchsorted(to_a, bounds_a, side="right"))

        self.known.update((c, len(self.written) + k) for k, c in enumerate(chunks))
        self.written += ["".join(signs[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        numbers = np.column_stack([in_a, in_b, groups])
        numbers[~whole] = -1
        self.numbers = np.concatenate([self.numbers, numbers])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(links)])
        self.keys = np.concatenate([self.keys, found.a[at_a] * self.width + found.b[at_b]])

    def summaries(self, texts: list[str]) -> Iterator[Summary]:
        """One for each text; an empty text and one whose bytes differ have no tokens."""
        parts = [self.chunks(t) if t else [] for t in texts]
        if len(self.known) > CACHED:
            self._make_room()
        new = list(dict.fromkeys(c for p in parts for c in p if c not in self.known))
        if new:
            # many small objects without cycles: counting references is enough
            gc.disable()
            try:
                self._learn(new)
            finally:
                gc.enable()
        places = [list(map(self.known.__getitem__, p)) for p in parts]
        lengths = np.array([len(p) for p in places], dtype=np.int64)
        at = np.fromiter(chain.from_iterable(places), np.int64, int(lengths.sum()))
        self.uses = np.bincount(at, minlength=len(self.written)) + np.pad(self.uses, (0, len(self.written) - len(self.uses)))
        owner = np.repeat(np.arange(len(texts)), lengths)
        lost = np.bincount(owner, weights=self.numbers[at, 0] < 0, minlength=len(texts)) > 0
        numbers = np.column_stack([_split_sums(self.numbers[at, k], np.cumsum([0, *lengths])) for k in range(3)])

        links = self.bounds[at + 1] - self.bounds[at]
        total = np.cumsum(links)
        held = np.repeat(owner, links)
        keys = self.keys[np.arange(len(held)) + np.repeat(self.bounds[at] - (total - links), links)]
        size = np.int64(len(self.a_bytes) + 1) * self.width
        pairs, times = np.unique(held * size + keys, return_counts=True)
        cuts = np.searchsorted(pairs, np.arange(len(texts) + 1) * size)
        n_links = np.bincount(held, minlength=len(texts))
        for k, own in enumerate(places):
            if not own or lost[k]:
                yield Summary(0, 0, 0, 0, "", pairs[:0], times[:0])
                continue
            digest = hashlib.sha256("".join([self.written[i] for i in own])[:-1].encode()).hexdigest()
            inside = slice(cuts[k], cuts[k + 1])
            yield Summary(*map(int, numbers[k]), int(n_links[k]), digest, pairs[inside] - k * size, times[inside])


class Summary(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups_sha256: str
    keys: np.ndarray  # of the different linked pairs, ascending
    times: np.ndarray


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """Loaded once per Python worker."""
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, a_ids, a_ends, b_ids, b_ends, a_groups, b_groups for every row of ``docs``.

    Ends are byte offsets in the blank and the text; ``a_groups`` and ``b_groups`` say how many tokens lie before the
    end of each group. A row without tokens has empty arrays.
    """

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = aligner(a_path, b_path)
        none = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for first, run in grouped(((t or "").encode() for t in batch["text"])):
                rows = []
                for raw in run:
                    found = own.whole(raw.decode()) or Aligned(none, none, none, none)
                    rows.append((found.a, found.a_ends, found.b, found.b_ends, *found.groups()))
                out = batch.iloc[first:first + len(run)][["doc_id"]].copy()
                for name, values in zip(("a_ids", "a_ends", "b_ids", "b_ends", "a_groups", "b_groups"), zip(*rows, strict=True), strict=True):
                    out[name] = list(values)
                yield out

    arrays = ", ".join(f"{n} array<long>" for n in ("a_ids", "a_ends", "b_ids", "b_ends", "a_groups", "b_groups"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(align, f"doc_id long, {arrays}")


_SLICED = pa.schema([
    ("slice", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("keys", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("pair_docs", pa.list_(pa.int64())),
])
_SLICED_DDL = (
    "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "keys binary, times binary, pairs array<long>, pair_docs array<long>"
)
_DIGEST_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_FEW = 2000  # rows in a batch


def sliced(docs: DataFrame, a_path: str, b_path: str, size: int | None = None) -> DataFrame:
    """A row per document with the keys of its linked pairs, and a row per slice with the documents of each pair."""
    largest = size or SLICE

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        # a task that runs again numbers its slices as before
        number = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        waiting: list[tuple] = []
        filled = 0

        def written() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*waiting, strict=True), _SLICED.types, strict=True)], schema=_SLICED)
            waiting.clear()
            return out

        def closed() -> tuple:
            pairs, documents = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return (number, None, 0, 0, 0, 0, "", None, None, pairs, documents)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first, run in grouped(t or b"" for t in texts):
                for k, found in enumerate(own.summaries([t.decode() for t in run])):
                    waiting.append((number, ids[first + k], *found[:5], found.keys.astype("<i8").tobytes(),
                                    found.times.astype("<i4").tobytes(), None, None))
                    held.append(found.keys)
                    filled += len(run[k])
                    if filled >= largest or len(held) >= _FEW:
                        waiting.append(closed())
                        number, filled = number + 1, 0
                    if len(waiting) >= _FEW or filled == 0:
                        yield written()
        if held:
            waiting.append(closed())
        if waiting:
            yield written()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return chosen.mapInArrow(rows, _SLICED_DDL)


def corpus_links(slices: DataFrame, width: int) -> DataFrame:
    """pair, n, best: in how many documents the ids a and b of ``pair = a * width + b`` are linked.

    ``best`` says that no other b is linked with a in more documents.
    """
    pairs = slices.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("n")).withColumn(
        "a", F.call_function("div", "pair", F.lit(width)))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most as many rows as A has ids
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_digests(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    slices = stored(sliced(docs, a_path, b_path), "slices")
    links = stored(corpus_links(slices, aligner(a_path, b_path).width), "links")
    wanted = slices.where("pairs IS NOT NULL").select(F.col("slice").alias("of_slice"), F.explode("pairs").alias("pair"))
    counted = wanted.join(links, "pair").select("of_slice", "pair", "n", "best")
    documents = slices.where("pairs IS NULL").drop("pairs", "pair_docs")

    def look_up(own: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        counted = counted.sort_values("pair")
        pairs, n, best = (counted[c].to_numpy() for c in ("pair", "n", "best"))
        out = own[["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]].copy()
        n_best, count_sum = [], []
        for keys, times in zip(own["keys"], own["times"], strict=True):
            at = np.searchsorted(pairs, np.frombuffer(keys, "<i8"))
            often = np.frombuffer(times, "<i4").astype(np.int64)
            n_best.append(int((often * best[at].astype(np.int64)).sum()) if len(at) else 0)
            count_sum.append(int((often * n[at]).sum()) if len(at) else 0)
        return out.assign(n_best=n_best, count_sum=count_sum)

    return documents.groupBy("slice").cogroup(counted.groupBy("of_slice")).applyInPandas(look_up, _DIGEST_DDL)
