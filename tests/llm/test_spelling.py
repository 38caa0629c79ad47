"""Spelling variants against brute force, on odd rows."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import CLASHING

from millrace.llm import bitmaps, spelling


def words_of(rows, rule):
    total = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % rule.slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= rule.letters:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= rule.seen}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, rule):
    n = words_of(rows, rule)
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= rule.times * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return out


def got(frame):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


@pytest.fixture
def rows(odd_texts):
    pick = random.Random(8)
    letters = "abcdefgé×ÿ"
    base = ["".join(pick.choices(letters, k=pick.randrange(6, 11))) for _ in range(60)]
    texts = []
    for k in range(300):
        own = []
        for _ in range(60):
            word = base[min(59, int(pick.expovariate(0.12)))]
            at, kind = pick.randrange(len(word)), pick.random()
            if kind < 0.1:
                word = word[:at] + word[at + 1 :]
            elif kind < 0.2:
                word = word[:at] + pick.choice(letters) + word[at + kind_of(k) :]
            own.append(word.upper() if k % 7 == 0 else word)
        texts.append("-".join(own))
    chain = ["aaaaaa"] * 3000 + ["aaaaab"] * 500 + ["aaaabb"] * 90 + ["aaabbb"] * 15
    texts += [" ".join(chain), "x" * 5000, "x" * 5000, "x" * 4999 + "y", None, "", "12 !"]
    texts += ["x" * 5000] * 5 + ["x" * 4999 + "y"] * 40
    return list(enumerate(odd_texts + texts)) + [(None, "NOBODY " * 6), (None, None), (3, "Seventh seventh " * 5)]


def kind_of(k):
    return k % 2


@pytest.mark.parametrize("rule", [spelling.Rule(), spelling.Rule(letters=4, seen=2, slip=7, times=2, symbols=3), spelling.Rule(symbols=1)])
def test_variants(frame, rows, rule):
    found = got(spelling.variants(frame(rows, CLASHING), rule=rule))
    want = brute(rows, rule)
    assert found == want
    assert sum(x[3] is not None for x in want) > 10 and any(x[3] not in (None, x[5]) for x in want)


def test_small_counters_and_full_bitmaps(frame, rows, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 50)
    monkeypatch.setattr(spelling, "TOGETHER", 100)
    monkeypatch.setattr(bitmaps, "MOST_LOG2", 16)
    assert got(spelling.variants(frame(rows))) == brute(rows, spelling.Rule())


def test_other_names_and_text_ids(frame, rows):
    docs = frame(rows).select(F.col("doc_id").cast("string").alias("a.b"), F.col("text").alias("the text"))
    assert got(spelling.variants(docs, "a.b", "the text")) == brute(rows, spelling.Rule())


def test_empty_table(frame):
    assert spelling.variants(frame([])).collect() == []


def test_lower_half_of_the_neighbourhood():
    """Of any two reduced words one edit apart one is generated from the other, and each only once."""
    table = np.zeros(256, np.uint64)
    table[ord("a") : ord("e")] = [1, 2, 3, 4]
    words = ["".join(p) for n in (1, 2, 3, 4) for p in np.array(np.meshgrid(*["abcd"] * n)).reshape(n, -1).T.tolist()]
    own = spelling.reduced_hashes(words, table)
    assert len(set(own.tolist())) == len(words)
    name = dict(zip(own.tolist(), words, strict=True))
    met = collections.Counter()
    for places, hashes in spelling.lower_neighbours(words, table):
        for k, h in zip(places.tolist(), hashes.tolist(), strict=True):
            if h in name:
                met[words[k], name[h]] += 1
    assert set(met.values()) == {1}
    for a in words:
        for b in words:
            if one_edit(a, b):
                assert ((a, b) in met) != ((b, a) in met)
        assert (a, a) in met
    assert all(a == b or one_edit(a, b) for a, b in met)


def test_bitmap(spark):
    keys = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 3000)
    there = bitmaps.bitmap(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert there.marked(keys).all()
    others = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    assert there.marked(others).mean() < 0.03
    assert not bitmaps.bitmap(spark.createDataFrame([], "k long"), "k").marked(others).any()
