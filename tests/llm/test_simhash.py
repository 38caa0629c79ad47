"""SimHash near duplicates against brute force, on odd rows."""

import re

import numpy as np
import pytest
import xxhash
from samples import CLASHING

from millrace.llm import simhash


def print_of(text, words=4):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def roots_of(prints, radius=4):
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def least_ids(rows, prints, radius=4):
    roots = roots_of(prints, radius)
    least = {}
    for (key, _), root in zip(rows, roots, strict=True):
        if key is not None:
            least[root] = min(least.get(root, key), key)
    return [least.get(root) for root in roots]


@pytest.fixture
def rows(odd_texts):
    own = list(enumerate(odd_texts)) + [(None, "no id here at all"), (None, None), (3, "One"), (3, "other text under a used id"), (None, "nobody else has this")]
    base = [f"w{i % 97}" for i in range(900)]
    for i in range(40):
        near = list(base)
        near[(37 * i) % 900] = f"edit{i}"
        own.append((500 + i, " ".join(near)))
    return own


@pytest.mark.parametrize("tile", [1 << 16, 16])
def test_report(frame, rows, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.report(frame(rows, CLASHING)).collect()), key=repr)
    prints = [print_of(t) for _, t in rows]
    want = sorted(((k, f"{p:016x}", c) for (k, _), p, c in zip(rows, prints, least_ids(rows, prints), strict=True)), key=repr)
    assert got == want
    assert len({c for _, _, c in got}) > 10


def test_other_words_and_radius(frame, rows):
    got = {(r.doc_id, r.component_id) for r in simhash.report(frame(rows), words=2, radius=9).collect()}
    prints = [print_of(t, 2) for _, t in rows]
    assert got == {(k, c) for (k, _), c in zip(rows, least_ids(rows, prints, 9), strict=True)}


def test_keep_one(frame, rows):
    docs = frame(rows, CLASHING).withColumnRenamed("rank", "a.b")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    prints = [print_of(t) for _, t in rows]
    want = [(k, t) for (k, t), c in zip(rows, least_ids(rows, prints), strict=True) if k is not None and k == c]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(map(repr, (x for x in got if x[0] is not None))) == sorted(map(repr, want))
    assert sum(x[0] is None for x in got) == sum(k is None for k, _ in rows)


def test_empty_table(frame):
    assert simhash.report(frame([])).collect() == []
    assert simhash.keep_one(frame([])).collect() == []


def test_long_text_counts_beyond_a_lane(monkeypatch):
    monkeypatch.setattr(simhash, "LANE_ROWS", 7)
    hashes = np.random.default_rng(3).integers(0, 2**64, 60, dtype=np.uint64)
    counts = np.array([0, 25, 7, 1, 0, 27])
    got, at = simhash.majority_bits(hashes, counts), 0
    for k, n in enumerate(counts.tolist()):
        own = hashes[at : at + n].tolist()
        at += n
        assert int(got[k]) == sum((2 * sum(h >> b & 1 for h in own) > n) << b for b in range(64))


@pytest.mark.parametrize("same", [True, False])
def test_skipped_runs_hold_no_pair(monkeypatch, same):
    monkeypatch.setattr(simhash, "LEAF", 8)
    pick = np.random.default_rng(4)
    seeds = pick.integers(0, 2**64, 40, dtype=np.uint64)
    near = [int(seeds[k % 40]) ^ sum(1 << int(b) for b in pick.integers(0, 64, int(pick.integers(0, 6)))) for k in range(600)]
    prints = np.unique(np.array(near, np.uint64))
    order = np.lexsort([prints, *simhash._counts(prints)[[3, 2, 1, 0]]])
    prints = prints[order]
    one, two = (prints, prints) if same else (prints[::2], prints[1::2])
    names = one if same else np.concatenate([one, two])
    edges = simhash.close_pairs(one, two, same, 4)
    up = list(range(len(names)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges.T.tolist():
        a, b = find(a), find(b)
        assert a != b
        up[max(a, b)] = min(a, b)
    want = list(range(len(names)))

    def root(x):
        while want[x] != x:
            x = want[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            across = same or (i >= len(one)) != (j >= len(one))
            if across and (int(names[i]) ^ int(names[j])).bit_count() <= 4:
                a, b = root(i), root(j)
                want[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(names))] == [root(i) for i in range(len(names))]
    assert len({find(i) for i in range(len(names))}) < len(names)
