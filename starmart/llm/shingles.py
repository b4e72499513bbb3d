"""Hashed word shingles of a text, in numpy."""

from __future__ import annotations

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), list(SPACES))
_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes handled at once.
PIECE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> np.ndarray:
    steps = np.full(count, _STEP)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS = powers(256)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word, A-Z lowered; words are what ASCII white space separates."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] not in SPACES:
            end += 1
        found.append(_piece_hashes(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _piece_hashes(codes: np.ndarray) -> np.ndarray:
    inside = ~_SPACE[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    # Positions within words of all bytes of words, word after word.
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    longest = int(lengths.max())
    table = _POWERS if longest <= len(_POWERS) else powers(longest)
    values = _VALUE[_LOWER[codes[inside]]] * table[place]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words as sorted 64-bit hashes; all words as one if they are fewer."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    width = min(size, len(words))
    total = words[: len(words) - width + 1]
    for k in range(1, width):
        total = mixed(total) * _STEP + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(total + np.uint64(width)))
