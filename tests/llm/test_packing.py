"""The plan's bins against every constraint, and a whole packing of awkward rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import documents
from tokenizers import Tokenizer

from ledgerloom.llm import packing, tokens


def filled(plan):
    bins = defaultdict(list)
    for i in range(len(plan["length"])):
        length, copies = int(plan["length"][i]), int(plan["copies"][i])
        for s in range(int(plan["count"][i])):
            bins[int(plan["bin"][i]) + s // copies].append((int(plan["offset"][i]) + s % copies * length, length))
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("room", [(1024, 1024, 1024**2), (1024, 3, 500_000), (100, 100, 10_000)])
def test_bins_keep_every_constraint(rule, room):
    rng = np.random.default_rng(1)
    most = min(room[0], int(room[2] ** 0.5))
    counts = Counter(min(int(x) + 1, most) for x in rng.exponential(200, 3000))
    plan = packing.plan(counts, *room, rule=rule)
    bins = filled(plan)
    assert len(bins) == plan["bins"][0]
    assert Counter(length for b in bins.values() for _, length in b) == counts
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= room[0] and len(content) <= room[1] and sum(x * x for _, x in content) <= room[2]
    if rule == "norm" and room[1] == 1024:
        assert len(bins) <= np.ceil(sum(k * v for k, v in counts.items()) / room[0]) + 2


def test_plan_places_one_by_one():
    """Runs of like bins are what placing the pieces singly gives."""
    counts = {7: 5, 5: 4, 3: 9, 2: 6, 1: 3}
    capacity, weight = np.array([20, 4, 150]), np.array([1.0, 0.01, 0.01])
    bins: list[np.ndarray] = []
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length])
        for _ in range(counts[length]):
            fits = [i for i, b in enumerate(bins) if (b >= need).all()]
            if not fits:
                bins.append(capacity.copy())
                fits = [len(bins) - 1]
            best = min(fits, key=lambda i: (weight * ((bins[i] - need) / capacity) ** 2).sum())
            bins[best] = bins[best] - need
    want = sorted(tuple(b) for b in bins)
    got = []
    for content in filled(packing.plan(counts, 20, 4, 150)).values():
        got.append((20 - sum(x for _, x in content), 4 - len(content), 150 - sum(x * x for _, x in content)))
    assert sorted(got) == want
    with pytest.raises(ValueError):
        packing.plan({30: 1}, 20, 4, 2000)


def test_awkward_rows(spark):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "no id"), (1, "hello world"), (4, "many words " * 3000), (5, "x " * 1023), (6, "x " * 1024)]
    got = packing.pack(documents(spark, rows), tokens=1024).collect()
    plain = Tokenizer.from_file(tokens.vocabulary())
    ids = {(d, t): np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    want = Counter()
    for d, t in rows:
        start = 0
        for piece, length in enumerate(packing.cut_lengths(len(ids[d, t]), 1024)):
            want[d, piece, start, length, zlib.crc32(ids[d, t][start : start + length].tobytes())] += 1
            start += length
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for content in sequences.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 1024
    limited = packing.pack(documents(spark, rows[:4]), documents=1).collect()
    assert len({r.sequence_id for r in limited}) == len(limited) == 4
    assert packing.pack(documents(spark, rows).limit(0)).count() == 0
