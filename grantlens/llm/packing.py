"""Pack tokenized documents into windows by multiway differencing (Karmarkar-Karp).

Documents become token ids, an end token added, and are cut: whole windows first, what is left in
pieces of at most ``piece`` ids. The small pieces are dealt evenly to blocks of about ``block_tokens``
tokens, whatever document or source they come from, and each block is packed by itself: every piece
starts as a partial partition with one filled slot, and the two partitions of the largest imbalance
are merged, largest slots with smallest, until one is left. The number of windows of a block starts
at the least possible and rises while a window exceeds the capacity.

A null text is an empty one and becomes the end token alone; so does a text of blanks. Documents of
any length are cut as they are tokenized. Repeated rows are packed each. An empty table gives no
pieces. Further columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import stored, text_or_empty

CAPACITY = 4096
END = 2
PIECE = 256
BLOCK_TOKENS = 2_000_000
REMEMBERED = 800_000  # words whose ids a worker remembers at a time

#: The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves,
#: the others for the next free code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=1)
def coder_of(path: str) -> WordCoder:
    """One for all tasks of a Python worker."""
    return WordCoder(path)


class WordCoder:
    """Ids of a text by a tokenizer that never joins what blanks separate, word by word.

    Equal words have equal ids, so each different word is encoded once and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        last = max(self.tokenizer.get_vocab().values())
        self.bytes_of = [k.to_bytes(4, "little") for k in range(last + 1)]

    def _encode(self, word: bytes) -> bytes:
        # one by one: a batch of few words would wake a thread on every core of the machine
        return b"".join([self.bytes_of[k] for k in self.tokenizer.encode(word.decode(), add_special_tokens=False).ids])

    def _merge(self, word: bytes) -> bytes:
        """Ids of a word of lower-case letters, which only the merges have to look at."""
        signs = word.decode() if word.isascii() else word.decode("latin-1").translate(_BYTE_SIGNS)
        return b"".join([self.bytes_of[t.id] for t in self.tokenizer.model.tokenize(signs)])

    def _learn(self, words: set[bytes]) -> None:
        """A mark after an ASCII letter or digit is a token of its own: stem and mark are learned apart."""
        known = self.known
        ends = [w for w in words if w[-1:] in b".," and len(w) > 1 and w[-2:-1].isalnum()]
        plain = words.difference(ends).union([w[:-1] for w in ends], (b".", b",") if ends else ())
        for w in plain.difference(known):
            if w.isascii():
                merges = w.isalpha() and w.islower()
            else:
                letters = w.decode()
                merges = letters.isalpha() and letters == letters.lower() and is_normalized("NFC", letters)
            known[w] = self._merge(w) if merges else self._encode(w)
        for w in ends:
            known[w] = known[w[:-1]] + known[w[-1:]]

    def encode(self, text: str) -> bytes:
        raw = text.encode("utf-8", "replace")
        if b"<|" not in raw:  # marks of special tokens are matched before case is dropped
            raw = raw.lower()
        words = raw.split()
        known = self.known
        missing = set(words).difference(known)
        if missing:
            if len(known) > REMEMBERED:
                known.clear()
                missing = set(words)
            self._learn(missing)
        return b"".join(map(known.__getitem__, words))


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens for each piece of each document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = coder_of(tokenizer)
        end = np.asarray([END], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = coder.encode(text) + end
                total = len(ids) // 4
                whole = total // capacity * capacity
                starts = [*range(0, whole, capacity), *range(whole, total, piece)]
                for start, stop in zip(starts, [*starts[1:], total], strict=True):
                    rows.append((doc_id, start, stop - start, zlib.crc32(ids[4 * start:4 * stop]), total))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(cut, _PIECES)


def differencing(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The way each size goes to, by merging the partial partitions of the largest imbalance."""
    n = len(sizes)
    # A partition is two arrays, slots in descending order of their sums: the sums and the slots'
    # nodes. Nodes below n are items; each further one joins two others. Empty slots are left out.
    children: list[tuple[int, int]] = []
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    if not heap:
        return np.zeros(0, dtype=np.int64)
    serial = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        # A partition with an empty slot stays the most imbalanced one while others fit beside its slots.
        more_sums, more_nodes, filled = [sums], [nodes], len(sums)
        while heap and filled + len(heap[0][2]) <= ways:
            _, _, other, others = heapq.heappop(heap)
            more_sums.append(other)
            more_nodes.append(others)
            filled += len(other)
        sums, nodes = np.concatenate(more_sums), np.concatenate(more_nodes)
        if len(more_sums) == 1:  # the smallest slots of one meet the largest of the other, crosswise
            _, _, other, others = heapq.heappop(heap)
            clash = len(sums) + len(other) - ways
            a, b = len(sums) - clash, slice(clash - 1, None, -1)
            joined = np.arange(n + len(children), n + len(children) + clash)
            children.extend(zip(nodes[a:].tolist(), others[b].tolist(), strict=True))
            sums = np.concatenate([sums[:a], sums[a:] + other[b], other[clash:]])
            nodes = np.concatenate([nodes[:a], joined, others[clash:]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == ways else 0)
        serial += 1
        heapq.heappush(heap, (-spread, serial, sums, nodes))
    way = np.zeros(n, dtype=np.int64)
    for slot, node in enumerate(heap[0][3].tolist()):
        below = [node]
        while below:
            node = below.pop()
            if node < n:
                way[node] = slot
            else:
                below.extend(children[node - n])
    return way


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each size; no window holds more than ``capacity``."""
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        way = differencing(sizes, ways)
        most = int(np.bincount(way, weights=sizes).max()) if len(sizes) else 0
        if most <= capacity:
            return way
        ways += max(1, ways * (most - capacity) // (4 * capacity))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, piece: int = PIECE,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The pieces with sequence_id and offset; a sequence holds ``capacity`` ids at most."""
    pieces = stored(tokenized_pieces(docs, tokenizer, capacity, piece), "pieces")
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") == capacity).select(
        *pieces.columns, (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.where(F.col("length") < capacity)
    tokens = pieces.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(tokens / block_tokens))

    columns = [*pieces.columns, "sequence_id", "offset"]

    def pack_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["row"], ignore_index=True)
        block["window"] = pack_sizes(block["length"].to_numpy(np.int64), capacity)
        block["offset"] = block.groupby("window")["length"].cumsum() - block["length"]
        block["sequence_id"] = 2 * (block["block"].astype("int64") * (1 << 31) + block["window"])
        return block[columns].astype({"doc_id": "Int64"})

    packed = (
        rest.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(pack_block, f"{_PIECES}, sequence_id long, offset long")
    )
    return full.unionByName(packed)
