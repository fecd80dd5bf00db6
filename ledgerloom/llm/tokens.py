"""Token ids of many texts by a public byte-level BPE file, each different word encoded once a worker.

The vocabulary's splitting pattern never lets a token cross from a visible character to a following blank, so a
text may be cut there and its ids are those of the pieces. Cuts are made only before a space or line feed and
after a character that no definition counts as white space (visible ASCII, U+00C0 to U+07FF). A text that holds the string of
an added token is left to the library as a whole, which takes such strings as those tokens.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words a worker remembers: a bound on memory; further words are encoded each time they come.
KEPT_WORDS = 250_000
JOINED_WORDS = 400

_encoders: dict[str, Encoder] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str) -> Encoder:
    """This worker's encoder for a vocabulary file (a name in the public folder, or a path)."""
    if name not in _encoders:
        _encoders[name] = Encoder(name if os.path.isabs(name) else vocabulary(name))
    return _encoders[name]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, number in vocab.items():
            self.widths[number] = len(token)  # one character of the byte alphabet for each byte
        self.known = pa.array([], pa.large_string())  # the words of the first places of the pool
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.words = 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the id offsets of each text; arguments as of ``textbytes.slices``."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hits = [m.start() for m in self.added.finditer(data)] if self.added else []
        if not hits:
            return self._encode(data, offsets)
        odd = np.unique(np.searchsorted(offsets, hits, "right") - 1)
        out, cuts, at = [], [np.zeros(1, np.int64)], 0
        for i in [*odd.tolist(), len(offsets) - 1]:
            own = offsets[at : i + 1]
            parts = [self._encode(data[own[0] : own[-1]], own - own[0])] if i > at else []
            if i < len(offsets) - 1:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                parts.append((ids, np.array([0, len(ids)])))
            for ids, ends in parts:
                out.append(ids)
                cuts.append(ends[1:] + cuts[-1][-1])
            at = i + 1
        return np.concatenate(out), np.concatenate(cuts)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        safe = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
        safe[1:] |= (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
        cut[1:-1] = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & safe
        cut[offsets] = True
        cut[-1] = True
        bounds = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        kept = self.words, self.used
        slots = self._slots(coded.dictionary)[coded.indices.to_numpy()]
        lengths = self.lengths[slots]
        ends = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        ids = self.pool[np.repeat(self.starts[slots] - ends[:-1], lengths) + np.arange(ends[-1])]
        if self.words > KEPT_WORDS:  # the slots past the bound served this call only
            self.words, self.used = max(kept[0], len(self.known)), self._end(max(kept[0], len(self.known)))
        return ids, ends[np.searchsorted(bounds, offsets)]

    def _end(self, words: int) -> int:
        return int(self.starts[words - 1] + self.lengths[words - 1]) if words else 0

    def _slots(self, words: pa.Array) -> np.ndarray:
        """The place of each word's ids in the pool; unknown words are encoded first."""
        found = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            found[missing] = self._learn(words.take(pa.array(missing)))
        return found

    def _learn(self, words: pa.Array) -> np.ndarray:
        data, offsets = _bytes(words)
        sizes, last = np.diff(offsets), data[offsets[1:] - 1]
        # joined, a word must begin with a blank and end so that the next word's blank starts a token
        wide = (sizes > 1) & (data[offsets[1:] - 2] >= 0xC3) & (data[offsets[1:] - 2] <= 0xDF)
        plain = np.isin(data[offsets[:-1]], (0x20, 0x0A)) & (((last > 0x20) & (last < 0x7F)) | wide)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        sorted_words = words.take(pa.array(order))
        own, cuts = _bytes(sorted_words)
        smooth = int(plain.sum())
        groups = np.append(np.arange(0, smooth, JOINED_WORDS), smooth)
        joined = [own[cuts[a] : cuts[b]].tobytes().decode() for a, b in zip(groups, groups[1:])]
        odd = sorted_words.slice(smooth).to_pylist()
        coded = self.tokenizer.encode_batch_fast(joined + odd, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in coded])
        ends = np.cumsum(sizes[order])
        stops = np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1
        begins = np.concatenate([[0], stops[:-1]])
        first, self.words = self.words, self.words + len(order)
        while len(self.starts) < self.words:
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while len(self.pool) < self.used + len(ids):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[first : self.words] = begins + self.used
        self.lengths[first : self.words] = stops - begins
        self.used += len(ids)
        places = np.arange(first, self.words)
        self.known = pa.concat_arrays([self.known, sorted_words.slice(0, max(0, KEPT_WORDS - first))])
        slots = np.empty(len(words), np.int64)
        slots[order] = places
        return slots


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string array, and where each string starts and ends in them."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2], np.uint8), offsets
