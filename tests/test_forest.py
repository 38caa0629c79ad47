"""Forests that lie in a table: against a plain recursion, against MLlib, and wherever their nodes are grown."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import forest, learn


def noisy(spark, rows, parts, classes=2):
    """Rows of three columns; two tell of the label, with noise, one has four values."""
    draw = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 for i in range(5)]
    label = F.floor((draw[0] + draw[1] * 0.5 + draw[2] * 0.5) / 2 * classes)
    return spark.range(0, rows, 1, parts).select(
        "id", draw[0].alias("a.b"), draw[1].alias("b"), F.floor(draw[3] * 4).alias("c"), F.least(label, F.lit(classes - 1)).cast("double").alias("label"),
    )


COLUMNS = ["a.b", "b", "c"]


def recursion(layout, tree, x, label, count):
    """One tree in plain Python, as a function of a row's bins; a leaf answers with its counts."""
    def impurity(counts):
        n, left = sum(counts), 1.0
        for k in counts:
            left -= (k / n) * (k / n)
        return left

    def counted(rows):
        out = [0] * layout.classes
        for r in rows:
            out[label[r]] += int(count[r])
        return out

    def node(rows, number):
        counts, best = counted(rows), (0.0, None, None)
        closed = number > 1 and abs(impurity(counts)) < 1e-15 or number.bit_length() - 1 >= layout.depth
        for f in [] if closed else forest._choice(layout, tree, np.array([number]))[0]:
            for cut in range(layout.bins - 1):
                left = counted([r for r in rows if x[r][f] <= cut])
                right = [a - b for a, b in zip(counts, left, strict=True)]
                if min(sum(left), sum(right)) >= layout.least:
                    gain = impurity(counts) - sum(left) / sum(counts) * impurity(left) - sum(right) / sum(counts) * impurity(right)
                    if gain > best[0]:
                        best = gain, f, cut
        _, f, cut = best
        if f is None:
            return counts, None
        below = [node([r for r in rows if (x[r][f] <= cut) == side], 2 * number + (not side)) for side in (True, False)]
        leaves = [np.argmax(c) for c, rule in below if rule is None]
        return (counts, None) if len(leaves) == 2 and leaves[0] == leaves[1] else (counts, (f, cut, below))

    root = node([r for r in range(len(label)) if count[r]], 1)

    def leaf(row):
        counts, rule = root
        while rule:
            f, cut, below = rule
            counts, rule = below[int(row[f] > cut)]
        return np.array(counts, float)

    return leaf


@pytest.mark.parametrize("least, depth", [(1, 30), (3, 4)])
def test_forest_is_the_plain_recursion(spark, least, depth):
    rows = noisy(spark, 150, 1, classes=3)
    model = forest.grow(rows, COLUMNS, 3, depth, least, bins=8)
    found = [tuple(r) for r in model.transform(rows).select("label", "prediction").collect()]
    local = rows.collect()
    x = [[int(np.searchsorted(cuts, r[c])) for c, cuts in zip(COLUMNS, model.cuts, strict=True)] for r in local]
    label = [int(r.label) for r in local]
    trees = [recursion(model.layout, t, x, label, forest._counts(model.layout, t, 0, len(label))) for t in range(3)]
    votes = [sum(leaf(r) / leaf(r).sum() for leaf in trees) for r in x]
    assert found == [(float(k), float(np.argmax(v))) for k, v in zip(label, votes, strict=True)]
    assert model.layout.classes == 3 and model.layout.chosen == 2


def test_forest_does_not_depend_on_where_it_is_grown(spark, monkeypatch):
    rows = noisy(spark, 3000, 4).localCheckpoint()
    model = forest.grow(rows, COLUMNS, 5, 30)
    assert [top.state for top in model.tops] == [[forest.SUBTREE]] * 5
    whole = sorted(map(tuple, model.transform(rows).collect()))
    monkeypatch.setattr(forest, "SUBTREE_ROWS", 200)
    parted = forest.grow(rows, COLUMNS, 5, 30)
    assert all(10 < len(top.state) < 400 for top in parted.tops)
    assert parted.subtrees.count() > 25 and sorted(map(tuple, parted.transform(rows).collect())) == whole
    monkeypatch.setattr(forest, "SUBTREE_ROWS", 1)
    assert sorted(map(tuple, forest.grow(rows, COLUMNS, 5, 6).transform(rows).collect())) == sorted(map(tuple, grown_in_tasks(rows, monkeypatch).collect()))


def grown_in_tasks(rows, monkeypatch):
    monkeypatch.setattr(forest, "SUBTREE_ROWS", 1_000_000)
    return forest.grow(rows, COLUMNS, 5, 6).transform(rows)


def test_forest_is_as_good_as_the_library(spark):
    rows = noisy(spark, 4000, 4).localCheckpoint()
    train, test = learn.train_test(rows, "id")
    grown = forest.grow(train, COLUMNS, 30, 30)
    library = learn.fit(learn.random_forest(30, None), train.withColumnRenamed("a.b", "a"), ["a", "b", "c"])
    nodes, theirs = grown.subtrees.agg(F.sum("nodes")).first()[0], library.stages[-1].totalNumNodes
    assert abs(nodes / theirs - 1) < 0.1
    other = learn.quality(library, test.withColumnRenamed("a.b", "a"))["accuracy"]
    assert abs(learn.quality(grown, test)["accuracy"] - other) < 0.03


def test_search_keeps_large_forests_off_the_driver(spark, monkeypatch):
    fitted, library = [], learn.fit
    monkeypatch.setattr(learn, "fit", lambda estimator, train, columns: (fitted.append((estimator.getNumTrees(), estimator.getMaxDepth())), library(estimator, train, columns))[1])
    rows = noisy(spark, 4000, 4).withColumnRenamed("a.b", "a").localCheckpoint()
    train, test = learn.train_test(rows, "id")
    found = learn.grid_search(train, test, ["a", "b", "c"], [(3, 2, 2), (200, None, 2), (200, None, 2)]).collect()
    assert fitted == [(3, 2)]
    assert [(r.config, r.trees, r.depth) for r in found] == [(0, 3, 2), (1, 200, None), (2, 200, None)]
    assert found[1].accuracy == found[2].accuracy and [r.config for r in found if r.best] == [int(found[1].accuracy > found[0].accuracy)]


def test_nodes_are_bounded_before_training():
    assert learn.most_nodes(learn.random_forest(2, 3), 10**9) == 2 * 15
    assert learn.most_nodes(learn.random_forest(200, None), 1000) == 200 * 1999
    assert learn.most_nodes(learn.random_forest(200, None, split=10), 1000) == 200 * 399


def test_thresholds(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("many"), (F.col("id") % 3 * 2).cast("double").alias("few"), F.lit(1.0).alias("one"))
    many, few, one = forest.thresholds(rows, rows.columns, 10)
    assert few.tolist() == [1.0, 3.0] and one.tolist() == []
    assert len(many) == 9 and np.abs(many - np.arange(100, 1000, 100)).max() <= 2 and set(many % 1) == {0.5}


def test_odd_rows(spark):
    rows = [(float(i), i % 2 * 1.0, 1.0 if i >= 20 else 0.0) for i in range(40)]
    train = spark.createDataFrame(rows, "x double, y double, label double")
    model = forest.grow(train, ["x", "y"], 20, 5)
    asked = spark.createDataFrame([(1.0, 0.0, 0.0), (None, None, None), (39.0, 1.0, None), (1e9, 0.0, 1.0)], "x double, y double, label double").coalesce(1)
    assert [tuple(r) for r in model.transform(asked).collect()] == [(0.0, 0.0), (None, 1.0), (None, 1.0), (1.0, 1.0)]
    assert model.transform(asked.limit(0)).count() == 0
    for bad in [(None, 0.0, 0.0), (float("nan"), 0.0, 0.0), (float("inf"), 0.0, 0.0), (1.0, 0.0, None), (1.0, 0.0, 0.5), (1.0, 0.0, -1.0)]:
        with pytest.raises(ValueError, match="1 with"):
            forest.grow(train.union(spark.createDataFrame([bad], train.schema)), ["x", "y"], 2, 2)
    with pytest.raises(ValueError, match="0 rows"):
        forest.grow(train.limit(0), ["x", "y"], 2, 2)
    one = forest.grow(train.withColumn("label", F.lit(0.0)), ["x"], 3, 5)
    assert one.transform(train).select("prediction").distinct().collect()[0][0] == 0.0
