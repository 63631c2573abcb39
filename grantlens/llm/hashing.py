"""Vectorised hashes of the words and byte windows of whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

from grantlens.llm.common import BLANKS

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Case is dropped for A to Z only.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: A to Z lowered, and every ASCII character that is no letter made a blank.
LETTERS = bytes((b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE + np.uint64(seed))


_BYTE = _table(1)
_WORD = np.where(_IS_BLANK, np.uint64(0), _table(2))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Tokens(NamedTuple):
    """Words of several texts: their hashes, their first and last bytes' places, and where each text's begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = ~_IS_BLANK[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    spans = np.diff(starts, append=len(data))
    first = int(starts[0])
    place = np.arange(first, len(data)) - np.repeat(starts, spans)
    powers = _powers(int(spans.max()))
    sums = np.add.reduceat(_WORD[data[first:]] * powers[place], starts - first)
    return mixed(sums + (ends - starts).astype(np.uint64)), starts, ends


def word_tokens(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of ``raw``, which is worked through in chunks cut at blanks."""
    parts, at = [], 0
    while at < len(raw):
        stop = at + CHUNK
        if stop < len(raw):
            found = _BLANK.search(raw, stop)
            stop = found.start() if found else len(raw)
        hashes, starts, ends = _hash_words(raw[at:stop])
        parts.append((hashes, starts + at, ends + at))
        at = stop
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def grouped(texts: Iterable[bytes], limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about ``limit`` bytes, with the number of the first."""
    first, run, size = 0, [], 0
    for k, text in enumerate(texts):
        if run and size + len(text) > limit:
            yield first, run
            first, run, size = k, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def tokens_of(texts: list[bytes]) -> Tokens:
    """The words of all ``texts``; their places count in the texts joined by one blank each."""
    hashes, starts, ends = word_tokens(b"\n".join(texts))
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Tokens(hashes, starts, ends, np.searchsorted(starts, offsets))


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive values, by doubling."""
    if len(values) < length:
        return np.zeros(0, np.uint64)
    size, block, factor = 1, values, BASE
    done, total = 0, None
    while True:
        if length & size:
            part = block[done:]
            total = part if total is None else total[: len(part)] * factor + part[: len(total)]
            done += size
            if done == length:
                return total
        block = block[:-size] * factor + block[size:]
        with np.errstate(over="ignore"):
            size, factor = 2 * size, factor * factor


def byte_values(raw: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(raw, dtype=np.uint8)]
