"""Ranked lexical search against brute force, on odd rows."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import CLASHING

from millrace.llm import lexical

ITEMS = "item_id string, text string"


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(rows, items, k=50):
    own = [(key, collections.Counter(terms_of(t))) for key, t in rows]
    own = [(key, c) for key, c in own if c]
    n_all, length = len(own), sum(sum(c.values()) for _, c in own)
    df = collections.Counter(t for _, c in own for t in c)
    wanted = collections.defaultdict(set)
    for item, t in items:
        wanted[item].update(terms_of(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for key, c in own:
            m = 50 + 50 * sum(c.values()) * n_all // length
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, at, x[3], -x[0]) for at, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def rows(odd_texts):
    pick = random.Random(9)
    own = [(i, t) for i, t in enumerate(odd_texts) if t is None or len(t) < 20_000]
    own += [(None, "w1 w2 nobody"), (None, None), (3, "w1 one"), (3, "w1 one")]
    own += [(1000 + i, " ".join(pick.choices([f"w{j}" for j in range(60)], k=pick.randrange(1, 40)))) for i in range(400)]
    return own


@pytest.fixture
def items():
    pick = random.Random(10)
    own = [(f"i{i}", " ".join(pick.choices([f"W{j}" for j in range(120)], k=pick.randrange(1, 30)))) for i in range(25)]
    return own + [("empty", ""), ("none", None), ("blank", " .,! "), (None, "w5 w6"), (None, "w7"), ("i1", "w3 p1"), ("absent", "zzzz")]


def got(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"DOCS": 60, "LEAF": 3, "FAN": 3}, {"BLOCK_BYTES": 600, "PATH": 2, "ENTRIES": 500}])
def test_rank(spark, frame, rows, items, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(lexical, name, value)
    asked = spark.createDataFrame(items, ITEMS).withColumn("score", F.lit(1)).withColumn("key", F.lit(2))
    found = lexical.rank(frame(rows, CLASHING), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == brute(rows, items)


def test_fewer_ranks_and_other_names(spark, frame, rows, items):
    docs = frame(rows).withColumnRenamed("doc_id", "a.b").withColumnRenamed("text", "c d")
    found = lexical.rank(docs, spark.createDataFrame(items, ITEMS), key="a.b", text="c d", k=3)
    assert got(found.withColumnRenamed("a.b", "doc_id")) == brute(rows, items, 3)


def test_empty_tables(spark, frame, rows, items):
    none = spark.createDataFrame([], ITEMS)
    assert lexical.rank(frame(rows), none).collect() == []
    assert lexical.rank(frame([]), spark.createDataFrame(items, ITEMS)).collect() == []
    assert lexical.rank(frame([(1, None), (2, " ")]), spark.createDataFrame(items, ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]


def test_other_ids_are_refused(spark, frame, rows, items):
    with pytest.raises(TypeError):
        lexical.rank(frame(rows).withColumn("doc_id", F.col("doc_id").cast("string")), spark.createDataFrame(items, ITEMS))


def test_bounds_leave_subtrees_out(monkeypatch):
    """The search looks at a part of the documents and finds what looking at all of them finds."""
    monkeypatch.setattr(lexical, "LEAF", 8)
    pick = np.random.default_rng(6)
    vocabulary, docs = 200, 4000
    chosen = [np.unique(np.minimum(pick.zipf(1.3, int(pick.integers(1, 40))), vocabulary) - 1) for _ in range(docs)]
    df = np.bincount(np.concatenate(chosen), minlength=vocabulary)
    order = np.empty(vocabulary, np.int64)
    order[np.argsort(df, kind="stable")] = np.arange(vocabulary)
    vectors = [np.sort(order[c]) for c in chosen]
    first = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    term = np.concatenate(vectors)
    tf, m = pick.integers(1, 6, len(term)), pick.integers(50, 160, docs)
    weight = np.zeros(vocabulary, np.int64)
    weight[order] = np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1)))
    tree = lexical.Tree(first, term, tf, m)
    assert sorted(tree.order.tolist()) == list(range(docs))
    looked = 0
    for _ in range(20):
        terms = order[pick.choice(vocabulary, 12, replace=False)]
        by_term = np.zeros(vocabulary, np.int64)
        by_term[terms] = weight[terms]
        every = tree.scores(0, docs, by_term)
        bound = tree.bounds(terms, weight[terms])
        for (low, high), most in zip(tree.spans, bound, strict=True):
            assert every[low:high].max() <= most
        best = lexical.Best(10)
        looked += lexical.descend(tree, best, terms, weight[terms], by_term, tree.order, np.ones(docs, bool))
        want = sorted(zip((-every).tolist(), tree.order.tolist(), strict=True))[:10]
        assert list(zip((-best.score).tolist(), best.key.tolist(), strict=True)) == [x for x in want if x[0] < 0]
    assert looked < 0.4 * 20 * docs
