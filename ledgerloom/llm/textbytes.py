"""Words and word shingles of many texts at once, computed on their UTF-8 bytes with numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Words and shingles are known by
64-bit hashes, so two different shingles are taken for one with a chance of about 1 in 10^19 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at a time, so that temporary arrays stay small; one longer text is handled alone.
SLICE_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)

_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection for each seed)."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def base_powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        size = n + n // 4 + 1
        for at, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most`` bytes; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, n)
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the word offsets of each text (one more than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit hash for each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = base_powers(len(data))
    codes = _LOWER[data] if lower else data.astype(np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, text after text, and the shingle offsets of each text.

    A text of fewer words has its whole word sequence as its one shingle; a text without words has none.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths >= k, lengths - k + 1, np.minimum(lengths, 1))
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    run = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for j in range(k if len(run) else 0):
        run += hashes[j : len(hashes) - k + 1 + j] * np.uint64(pow(_WORD_BASE, j, 2**64))
    at = np.arange(out[-1]) - np.repeat(out[:-1] - offsets[:-1], counts)
    result = np.zeros(out[-1], np.uint64)
    whole = np.repeat(lengths >= k, counts)
    result[whole] = mix(run[at[whole]], k)
    for i in np.flatnonzero((lengths > 0) & (lengths < k)):
        value = sum(int(h) * pow(_WORD_BASE, j, 2**64) for j, h in enumerate(hashes[offsets[i] : offsets[i + 1]]))
        result[out[i]] = mix(np.array([value % 2**64], np.uint64), int(lengths[i]))[0]
    return result, out
