"""Words and word hashes of many texts at once, with numpy on UTF-8 bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. Hashes have 64 bits and are the same in
every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK_BYTES = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.arange(1, 257, dtype=np.uint64) * _ODD
_BYTE_VALUE = mix(_STEP)


def text_blocks(texts: pa.Array, most: int = _BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts a string column into blocks of whole texts: (first row, bytes, offsets of the texts); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (one more entry at the end)."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each lower-cased word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    powers = np.cumprod(np.full(int(place.max()) + 1, _ODD, np.uint64))
    terms = _BYTE_VALUE[_LOWER[data]]
    terms *= powers[place]
    terms[_SPACE[data]] = 0
    return mix(np.add.reduceat(terms, starts) + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, text by text, and the number of runs before each text.

    A text with fewer words has its whole sequence as its one shingle; without words it has none.
    """
    n = len(words)
    if not n:
        return words, np.zeros_like(first)
    runs = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        runs[: n - k] += mix(words[k:] + _STEP[k])
    runs = mix(runs)
    counts = np.diff(first)
    whole = np.zeros(n, bool)
    for t in np.flatnonzero((counts > 0) & (counts < width)):
        a, b = first[t], first[t + 1]
        parts = [mix(words[a + k : a + k + 1] + _STEP[k]) for k in range(b - a)]
        runs[a] = mix(np.sum(parts, axis=0, dtype=np.uint64) + np.uint64(b - a))[0]
        whole[a] = True
    left = np.repeat(first[1:], counts) - np.arange(n)
    keep = (left >= width) | whole
    return runs[keep], np.r_[0, np.cumsum(keep)][first]
