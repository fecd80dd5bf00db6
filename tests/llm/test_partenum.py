"""The Jaccard join against brute force, and the guarantee of its signatures."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import documents, sentence

import corpus_pipeline
from ledgerloom.llm import partenum


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("size", [1, 5, 7, 13, 20, 33, 60, 150, 700])
def test_similar_sets_share_a_signature(percent, size):
    threshold = Fraction(percent, 100)
    lows = partenum.size_bands(threshold)
    rng = np.random.default_rng(size)
    for _ in range(60):
        x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        while True:
            keep = rng.random(len(x)) > rng.random() * 0.25
            y = np.unique(np.concatenate([x[keep], rng.integers(0, 2**63, rng.integers(0, size // 6 + 2), dtype=np.uint64)]))
            shared = len(np.intersect1d(x, y))
            if len(y) and 100 * shared >= percent * (len(x) + len(y) - shared):
                break
        sides = []
        for s in (x, y):
            band = int(np.searchsorted(lows, len(s), "right")) - 1
            sides.append(np.concatenate([
                partenum.signatures(s, b, partenum.shape(threshold, int(lows[b + 1]) - 1)) for b in (band, band + 1)
            ]))
        assert len(np.intersect1d(*sides))


def corpus(rng):
    rows = [(i, " ".join(sentence(rng, rng.randrange(1, 120)))) for i in range(40)]
    at = 100
    for i in range(25):
        base = rows[i][1].split()
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "edited" + str(rng.randrange(1000))
            rows.append((at, " ".join(copy)))
            at += 1
    template = sentence(rng, 90)
    for _ in range(60):  # one large group of near copies that are not all alike
        copy = list(template)
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(len(copy))] = "other" + str(rng.randrange(9))
        rows.append((at, " ".join(copy)))
        at += 1
    line = " ".join(sentence(rng, 14))
    rows += [(at + j, line + " " + " ".join(sentence(rng, 8))) for j in range(50)]  # a shared line, not alike
    rng.shuffle(rows)
    return rows


def brute(rows, k, percent):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    label = [r[0] for r in rows]
    changed = True
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return sorted((r[0], len(s), c) for r, s, c in zip(rows, sets, label))


@pytest.mark.parametrize("k, percent, block", [(4, 85, 2048), (5, 80, 8)])
def test_components_equal_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(partenum, "BLOCK", block)  # groups over 8 become several cells
    rows = corpus(random.Random(k))
    got, links = partenum.jaccard_join(documents(spark, rows), k, percent)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k, percent)
    ids = {r[0] for r in rows}
    assert all(r.a in ids and r.b in ids for r in links.collect())


def test_awkward_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(5, "A b C d e"), (2, "a B c D e"), (9, None), (8, ""), (7, " \n\t"), (6, "one two"), (1, "ONE  two"), (None, "a b c d e"),
            (2, "a B c D e"), (3, long), (4, long + " tail"), (None, None), (10, "a b c"), (11, "É é"), (12, "é é")]
    got = sorted((tuple(r) for r in partenum.jaccard_join(documents(spark, rows), 4, 85)[0].collect()), key=str)
    want = [(5, 2, 2), (2, 2, 2), (9, 0, 9), (8, 0, 8), (7, 0, 7), (6, 1, 1), (1, 1, 1), (None, 2, 2), (2, 2, 2),
            (3, 29_997, 3), (4, 29_998, 3), (None, 0, None), (10, 1, 10), (11, 1, 11), (12, 1, 12)]
    assert got == sorted(want, key=str)
    assert partenum.jaccard_join(documents(spark, rows).limit(0))[0].count() == 0


def test_a_link_counts_only_the_text_it_names(spark):
    rng = random.Random(5)
    near, far, other = (sentence(rng, 60, 10**6) for _ in range(3))
    docs = documents(spark, [(7, " ".join(near)), (7, " ".join(far)), (9, " ".join([*near, "end"]))]).select("doc_id", "text")
    name = {t: partenum.node_of(next(partenum.text_sets(pa.array([" ".join(t)]), 5))) for t in (tuple(near), tuple(far), (*near, "end"))}
    nodes = spark.createDataFrame([(name[tuple(near)], 7, 56), (name[tuple(far)], 7, 56), (name[*near, "end"], 9, 57)], "node long, rep long, n_shingles long")
    pairs = spark.createDataFrame([(name[tuple(far)], name[*near, "end"]), (name[tuple(near)], name[*near, "end"])], partenum.PAIRS)
    found = partenum._links(docs, nodes, pairs, 5, Fraction(80, 100)).collect()
    assert [tuple(r) for r in found] == [(name[tuple(near)], name[*near, "end"])]


def test_one_text_of_each_component_stays_whatever_its_id(spark):
    rng = random.Random(6)
    clean, base, alone = (" ".join(sentence(rng, 60, 10**6)) for _ in range(3))
    rows = [(7, clean), (7, base + " end"), (3, base), (3, base), (5, alone), (5, clean + " end"), (8, ""), (8, None), (8, "one"), (None, base), (9, alone.upper())]
    docs = documents(spark, rows)
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    want = [(5, clean + " end"), (3, base), (5, alone), (8, ""), (8, None), (8, "one"), (None, base)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    rows = [(7, clean), (7, base + " end"), (3, base)]  # the clean text of 7 is no copy of anything
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), "")
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(3, base), (7, clean)]


@pytest.mark.parametrize("block", [2048, 8])
def test_all_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(partenum, "BLOCK", block)
    rows = corpus(random.Random(9))
    rows += [(1000, rows[3][1].upper()), (1001, rows[3][1]), rows[5], (1002, ""), (1003, None), (None, rows[3][1]), (1004, "one  two")]
    sets = [frozenset(partenum.text_sets(pa.array([t or ""]), 5).__next__().tolist()) for _, t in rows]
    alike = lambda x, y: bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)
    own = [i for i, r in enumerate(rows) if r[0] is not None]
    rep = {}
    for i in own:
        rep[sets[i]] = min(rep.get(sets[i], rows[i][0]), rows[i][0])
    classes = [x for x in rep if x]
    want = sorted(sorted((rep[x], rep[y])) for i, x in enumerate(classes) for y in classes[:i] if alike(x, y))
    links = partenum.jaccard_join(documents(spark, rows), 5, 80)[1]
    assert sorted(sorted(r) for r in links.collect()) == want
    counted, links = partenum.jaccard_links(documents(spark, rows), 5, 80)
    n = [(rows[i][0], sum(alike(sets[i], sets[j]) for j in own if j != i) if i in own else None) for i in range(len(rows))]
    assert sorted(((r.doc_id, r.n_links) for r in counted.collect()), key=str) == sorted(n, key=str)


def _reach(nodes, edges):
    """The smallest node that each node is connected with."""
    low = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.mark.parametrize("split", [False, True])
def test_family_cells_join_what_all_pairs_join(split):
    """Near sets around the threshold, some known to belong together: the few links connect what all true pairs do."""
    rng = np.random.default_rng(3 + split)
    base = [np.unique(rng.integers(1, 1 << 62, 90).astype(np.uint64)) for _ in range(4)]
    sets = []
    for i in range(60):
        keep = rng.random(len(base[i % 4])) < 0.92
        sets.append(np.unique(np.concatenate([base[i % 4][keep], rng.integers(1, 1 << 62, 4).astype(np.uint64)])))
    nodes, component = np.arange(60) + 1000, np.arange(60) + 1000
    component[20:30] = 1020  # joined before, whatever their sets
    threshold = Fraction(4, 5)
    shared = lambda x, y: len(np.intersect1d(x, y))
    true = [(i, j) for i in range(60) for j in range(i) if 5 * shared(sets[i], sets[j]) >= 4 * (len(sets[i]) + len(sets[j]) - shared(sets[i], sets[j]))]
    block = np.arange(60) % 2 if split else np.zeros(60, int)
    rows = []
    for low, high in {(min(a, b), max(a, b)) for a in block for b in block}:
        rows += [(7, low, high, block[i], nodes[i], component[i], sets[i].tobytes()) for i in range(60) if block[i] in (low, high)]
    names = ["family", "low", "high", "block", "node", "component", "elements"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    found = [tuple(r.values()) for out in partenum._links_of_family(threshold)(iter([batch])) for r in out.to_pylist()]
    known = [(component[i], nodes[i]) for i in range(60)]
    want = _reach(nodes, [*known, *((nodes[i], nodes[j]) for i, j in true)])
    assert _reach(nodes, [*known, *found]) == want and len(set(want.values())) > 4
    assert {(min(a, b), max(a, b)) for a, b in found} <= {(nodes[j], nodes[i]) for i, j in true}
    assert len(found) < (3 if split else 1) * 60
