"""Sparse hashed text features, computed on bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerloom.llm import textbytes
from ledgerloom.llm.textbytes import mix

BITS = 18
SIZE = 1 << BITS


def _slot(values: np.ndarray, family: int) -> np.ndarray:
    return (mix(values, family) >> np.uint64(64 - BITS)).astype(np.int64)


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """The different n-grams of each text as sorted slots: bytes (1 to 3), words (1 and 2), and echoes.

    An echo n-gram says for four words in a row which of them repeat the word before. A text without words has
    the n-grams of its blanks; an empty text has none.
    """
    seen = np.zeros(SIZE, bool)
    for _, data, offsets in textbytes.slices(texts, 500_000):
        codes = data.astype(np.uint64)
        two = codes[:-1] << np.uint64(8) | codes[1:]
        three = two[:-1] << np.uint64(8) | codes[2:]
        grams = [_slot(x, family) for family, x in ((1, codes), (2, two), (3, three))]
        starts, ends, cuts = textbytes.words(data, offsets)
        hashes = textbytes.word_hashes(data, starts, ends)
        single = _slot(hashes, 4)
        double = _slot(hashes[:-1] * np.uint64(3) + hashes[1:], 5) if len(hashes) > 1 else np.zeros(0, np.int64)
        same = np.zeros(len(hashes), np.uint64)
        same[1:] = hashes[1:] == hashes[:-1]
        echo = same[:-3] | same[1:-2] << np.uint64(1) | same[2:-1] << np.uint64(2) | same[3:] << np.uint64(3) if len(same) > 3 else same[:0]
        echo = _slot(echo, 6)
        for i in range(len(offsets) - 1):
            a, b, c, d = offsets[i], offsets[i + 1], cuts[i], cuts[i + 1]
            for n, gram in enumerate(grams):
                seen[gram[a : max(a, b - n)]] = True
            seen[single[c:d]] = True
            seen[double[c : max(c, d - 1)]] = True
            seen[echo[c : max(c, d - 3)]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found.astype(np.int32)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, counts) of each text's words, runs of letters in lower case (ASCII and Latin-1), and word beginnings.

    Beginnings of 4 and 5 bytes let inflected and derived forms share what is learned.
    """
    for _, data, offsets in textbytes.slices(texts, 500_000):
        plain = data.copy()
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        plain[upper] += 32
        plain[~_LETTER[plain]] = 0x20
        starts, ends, cuts = textbytes.words(plain, offsets)
        slots = np.stack([
            _slot(textbytes.word_hashes(plain, starts, np.minimum(ends, starts + most)), family)
            for family, most in ((7, len(plain)), (8, 4), (9, 5))
        ], 1)
        for i in range(len(offsets) - 1):
            yield np.unique(slots[cuts[i] : cuts[i + 1]], return_counts=True)
