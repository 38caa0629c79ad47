"""Physical plans: no nested loops, no Python where built-ins do, limits before shuffles, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered, relate, select
from millrace.plans import REGISTRY
from millrace.session import Tables

NATIVE = [n for n in sorted(REGISTRY) if n[0] in "apjowuqdtgl" and not n.startswith(("flagship",))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, sf_dir, name):
    text = plan(REGISTRY[name](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


@pytest.mark.parametrize("name", [n for n in sorted(REGISTRY) if n not in NATIVE and n[0] != "x"])
def test_other_plans_join_on_keys(spark, sf_dir, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(REGISTRY[name](spark, sf_dir)))


def test_ranks_are_selected_without_a_written_copy(spark, sf_dir, monkeypatch):
    t = Tables(spark, sf_dir)
    monkeypatch.setattr(ordered, "cut_lineage", None)
    text = plan(ordered.value_at_rank(t.events.select("event_type", "value"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95}))
    assert text.count("FileScan") <= 2
    assert not re.search(r"Window \[.*\], \[event_type#\d+\], \[value", text)


def test_keyword_entries_need_no_shuffle(spark, sf_dir):
    from millrace.operators.keywords import KeywordIndex

    t = Tables(spark, sf_dir)
    assert "Exchange" not in plan(KeywordIndex.entries_of(t.documents, "doc_id", "text"))


def test_top_n_is_cut_before_the_shuffle(spark, sf_dir):
    t = Tables(spark, sf_dir)
    text = plan(select.newest_per_key(t.events, ["user_id"], [F.col("ts").desc()], 5))
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert text.count("WindowGroupLimit") == 2


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(REGISTRY["p01_predicate_filter"](spark, sf_dir))
    assert "GreaterThan(l_quantity,25.0)" in text
    assert "l_extendedprice" not in text


def test_windows_run_inside_buckets(spark, sf_dir):
    t = Tables(spark, sf_dir)
    numbered = ordered.number_rows(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", ["event_id"])
    big = [m for m in re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan(numbered)) if "user_id" in m]
    assert any("__bucket" in m for m in big)


def test_pairs_use_an_equi_join(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    pairs = relate.unordered_pairs(df, "k", blocks=3)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(pairs))
    assert pairs.count() == 190


@pytest.mark.parametrize("name", ["q20_event_upgrade", "q21_error_counts"])
def test_events_are_parsed_once(spark, sf_dir, name):
    text = REGISTRY[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1 and text.count("json_object_keys(") <= 1


def test_training_rows_lie_in_parts(spark):
    from millrace.operators import learn

    few, many = (learn.training_rows(spark.range(n), "id", n) for n in (1999, 9000))
    assert few.rdd.getNumPartitions() <= spark.range(1999).rdd.getNumPartitions() and few.count() == 1999
    assert many.rdd.getNumPartitions() == 5 and many.count() == many.distinct().count() == 9000


def test_forests_keep_the_nodes_of_rows():
    from millrace.operators import learn

    forest = learn.random_forest(2, 3)
    assert forest.getCacheNodeIds()


def test_activity_is_written_before_it_is_labelled(spark, sf_dir, monkeypatch):
    from millrace.plans import learning

    monkeypatch.setattr(learning.ml, "training_rows", lambda df, key, rows: df)
    rows = learning.labelled(Tables(spark, sf_dir))
    assert "o_custkey" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_folds_are_fitted_two_at_a_time(spark, monkeypatch):
    from threading import Barrier

    from millrace.operators import learn

    meet = Barrier(2, timeout=20)
    monkeypatch.setattr(learn, "fit", lambda estimator, train, columns: (meet.wait(), train)[1])
    monkeypatch.setattr(learn, "quality", lambda train, test: {"accuracy": test.count() / (train.count() + test.count())})
    rows = spark.range(40).withColumn("label", F.col("id") % 2)
    got = learn.fold_accuracies(rows, "id", ["id"], learn.random_forest(2, 3), folds=4).collect()
    assert [r.fold for r in got] == [0, 1, 2, 3] and abs(sum(r.accuracy for r in got) - 1) < 1e-9
