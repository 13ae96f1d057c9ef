"""Words and word shingles of texts as 64-bit hashes, many texts at a time with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The bytes between words.
SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])

_random = np.random.default_rng(20240601)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALTS = _random.integers(1, 1 << 63, 64, dtype=np.uint64)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _STEP, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in a row (A-Z lower-cased), and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    inside = _IS_WORD[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(raw)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    place = _places(starts, len(raw))
    place = np.where(inside, place, 0)
    value = _BYTE[_LOWER[raw]] * _powers(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts)), counts


def _places(starts: np.ndarray, n: int) -> np.ndarray:
    """How far each byte lies behind the last word start; 0 before the first."""
    place = np.zeros(n, dtype=np.int32)
    lengths = np.diff(np.append(starts, n))
    place[starts[0] :] = np.arange(n - starts[0]) - np.repeat(starts - starts[0], lengths)
    return place


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles of ``size`` words in ascending order, and how many.

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    words, counts = word_hashes(texts)
    n = len(counts)
    owner = np.repeat(np.arange(n, dtype=np.int64), counts)
    first = np.cumsum(counts) - counts
    length = np.minimum(counts, size)
    total = np.zeros(len(words), dtype=np.uint64)
    place = np.arange(len(words)) - first[owner]
    for k in range(size):
        shifted = np.zeros(len(words), dtype=np.uint64)
        shifted[: max(len(words) - k, 0)] = words[k:]
        shifted[place + k >= counts[owner]] = 0
        total += mix(shifted + _SALTS[k]) * (shifted != 0)
    hashes = mix(total + length[owner].astype(np.uint64))
    kept = place + length[owner] <= counts[owner]
    hashes, owner = hashes[kept], owner[kept]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=n)
