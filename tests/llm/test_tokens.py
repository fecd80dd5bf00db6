"""The caching encoder against the tokenizers library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import textbytes, tokens

PIECES = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", " ", "　", "\u0085", "!!", "123", "日本", "😀", "'s",
          "<|endoftext|>", "\r\n", "\x0b", "߿", ".", "\x1c", "\x7f", " ", "words", " the"]


@pytest.mark.parametrize("kept", [tokens.KEPT_WORDS, 50])
def test_ids_equal_the_library(monkeypatch, kept):
    monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(1500)] + [None, "", " ", "\n"]
    plain = Tokenizer.from_file(tokens.vocabulary())
    own = tokens.Encoder(tokens.vocabulary())
    for _ in range(2):
        for first, data, offsets in textbytes.slices(pa.array(texts), 5000):
            ids, cuts = own.encode(data, offsets)
            for i in range(len(offsets) - 1):
                want = plain.encode(texts[first + i] or "", add_special_tokens=False).ids
                assert ids[cuts[i] : cuts[i + 1]].tolist() == want
    assert len(own.known) <= kept
    assert plain.encode("x <|endoftext|> y", add_special_tokens=False).ids == own.encode(*next(textbytes.slices(pa.array(["x <|endoftext|> y"])))[1:])[0].tolist()


def test_words_and_shingles_of_slices_equal_plain_python():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB \n\té.") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "x" * 5000]
    seen: dict = {}
    for first, data, offsets in textbytes.slices(pa.array(texts), 700):
        starts, ends, cuts = textbytes.words(data, offsets)
        hashes = textbytes.word_hashes(data, starts, ends)
        values, places = textbytes.shingles(hashes, cuts, 4)
        for i in range(len(offsets) - 1):
            text = texts[first + i] or ""
            words = [w for w in text.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
            words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
            want = [tuple(words[j : j + 4]) for j in range(max(1, len(words) - 3))] if words else []
            got = values[places[i] : places[i + 1]].tolist()
            assert len(got) == len(want)
            for g, w in zip(got, want):
                assert seen.setdefault(w, g) == g
    assert len(set(seen.values())) == len(seen)
    assert np.unique(np.array(list(seen.values()), np.uint64)).size == len(seen)
