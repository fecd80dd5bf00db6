"""Wavelet shards: every operation against the plain id list, and a round trip of awkward rows."""

import zlib

import numpy as np
import pytest
from llm_rows import documents
from tokenizers import Tokenizer

from ledgerloom.llm import tokens, wavelet


@pytest.mark.parametrize("n, symbols", [(0, 3), (1, 1), (9, 2), (200_000, 300), (70_000, 50_000)])
def test_shard_operations_equal_a_list(n, symbols):
    rng = np.random.default_rng(n + 1)
    ids = (rng.zipf(1.3, n) % symbols).astype(np.uint32)
    shard = wavelet.Shard(wavelet.build(ids, [None, 5], [n // 3, n - n // 3]))
    assert (shard.ids() == ids).all() and shard.doc_ids == [None, 5]
    for i in rng.integers(0, max(n, 1), 12 if n else 0):
        token = int(ids[i])
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        places = np.flatnonzero(ids == token)
        k = int(rng.integers(0, len(places)))
        assert shard.access(int(i)) == token
        assert shard.count(token, a, b) == (ids[a:b] == token).sum()
        assert shard.select(token, k) == places[k]
    assert shard.count(999_999) == 0
    with pytest.raises((IndexError, KeyError)):
        shard.select(999_999, 0)


def test_round_trip_of_awkward_rows(spark, monkeypatch):
    rows = [(3, "the cat"), (1, None), (2, ""), (None, "no id"), (3, "the cat"), (3, "another"), (-4, "x " * 30_000), (9, "\n\n"), (10, "!")]
    shards = wavelet.write_shards(documents(spark, rows), end_id=0)
    got = [tuple(r) for r in wavelet.read_documents(shards).select("start", "doc_id", "n_tokens", "ids_crc32").collect()]
    plain = Tokenizer.from_file(tokens.vocabulary())
    want = {}
    for doc, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(doc, []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for at, doc, n, crc in sorted(got):
        assert at == start and (n, crc) in want[doc]
        want[doc].remove((n, crc))
        start += n
    assert not any(want.values())
    order = [doc for _, doc, _, _ in sorted(got)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    cat = plain.encode("the cat", add_special_tokens=False).ids[1]
    found = sorted(tuple(r) for r in wavelet.find_token(shards, cat).collect())
    assert found == [(3, 1), (3, 1)]
    assert wavelet.count_token(shards, 0).agg({"n": "sum"}).first()[0] == 1 + len(rows)  # "!" is id 0, too


def test_an_empty_table_has_no_documents(spark):
    shards = wavelet.write_shards(documents(spark, [(1, "x")]).limit(0))
    assert wavelet.read_documents(shards).count() == 0
