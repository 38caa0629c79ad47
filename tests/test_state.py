"""Keyed state in buckets: appended batches, merges, look-ups without a shuffle of the state."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import features as fs
from millrace.operators.vectorsearch import upsert_chunks
from millrace.sources import state
from millrace.sources.state import KeyedState

VIEW = fs.FeatureView("v", "k", "ts", ("x",))


def batch(spark, number, keys=20, step=7):
    """Keys by number; every third batch holds older times."""
    shift = -500 if number % 3 == 2 else 0
    rows = spark.range(keys).select(((F.col("id") * step + number) % 31).alias("n"))
    rows = rows.select(F.concat(F.lit("k"), "n").alias("k"), F.timestamp_seconds(F.col("n") + number * 10 + shift).alias("ts"), (F.col("n") * 100 + number).alias("x"))
    return rows.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"), F.timestamp_seconds(F.lit(number)).alias("ts"), F.lit(number).cast("long").alias("x")))


def want(spark, numbers):
    best = {}
    for n in numbers:
        for r in batch(spark, n).collect():
            best[r.k] = max(best.get(r.k, r), r, key=lambda x: (x.ts, x.x))
    return sorted(map(tuple, best.values()), key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def exchanges(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bExchange\b", plan.split("== Initial Plan ==")[0]))


def test_fifty_pushes_stay_cheap_to_read(spark, tmp_path):
    like = batch(spark, 0)
    files = []
    for n in range(50):
        fs.push(batch(spark, n), VIEW, str(tmp_path), n)
        files.append(len(list(tmp_path.glob("runs/**/*.parquet"))))
    online = fs.serving_state(spark, VIEW, str(tmp_path), like)
    assert got(online.current()) == want(spark, range(50))
    assert max(len(online.runs(t)) for t in range(4)) < state.FAN
    # 50 runs are 3 tiers: no more files than three runs a tier have, at 12 pushes or at 50.
    assert max(files) <= 3 * (state.FAN - 1) * online.buckets + online.buckets
    assert online.rows().count() < 4 * 32 * 3


def test_only_requests_move(spark, tmp_path):
    for n in range(6):
        fs.push(batch(spark, n), VIEW, str(tmp_path), n)
    online = fs.serving_state(spark, VIEW, str(tmp_path), batch(spark, 0))
    assert exchanges(online.current()) == 0
    requests = spark.range(40).select(F.col("id").alias("position"), F.concat(F.lit("k"), "id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = fs.online_features(requests, online, VIEW)
        assert exchanges(found) == 1
        assert exchanges(online.lookup(requests)) == 1
        known = {r[0]: r[2] for r in want(spark, range(6))}
        assert {(r.position, r.x) for r in found.collect()} == {(i, known.get(f"k{i}")) for i in range(40)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_batch_replaces_itself_and_a_broken_merge_loses_nothing(spark, tmp_path):
    online = fs.serving_state(spark, VIEW, str(tmp_path), batch(spark, 0))
    for n in (0, 1, 1, 1):
        fs.push(batch(spark, n), VIEW, str(tmp_path), n)
    assert len(online.runs(0)) == 2
    # A merge that wrote its run and ended before it dropped the old ones.
    online._write(state.newest(online._declared(online._tier(0)), "k", ["ts"]), f"{online._tier(1)}/merge=x")
    assert got(online.current()) == want(spark, range(2))
    fs.push(batch(spark, 2), VIEW, str(tmp_path), 2)
    online.merge(everything=True)
    assert got(online.current()) == want(spark, range(3)) == got(online.rows())


def test_buckets_are_the_states_own(spark, tmp_path):
    schema = batch(spark, 0).schema
    KeyedState(spark, str(tmp_path), schema, "k", ["ts"], buckets=3).put(batch(spark, 0), 0)
    again = KeyedState(spark, str(tmp_path), schema, "k", ["ts"], buckets=9)
    again.put(batch(spark, 1), 1)
    assert again.buckets == 3 and got(again.current()) == want(spark, range(2))
    assert len(list(tmp_path.glob("runs/**/*.parquet"))) <= 6
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("state_")]


def test_nothing_stored_yet(spark, tmp_path):
    online = fs.serving_state(spark, VIEW, str(tmp_path), batch(spark, 0))
    assert online.current().collect() == [] and online.lookup(batch(spark, 0).select("k")).count() == 21


def test_chunks_without_a_vector_are_skipped(spark, tmp_path):
    rows = lambda load, *items: spark.createDataFrame([(i, v, load) for i, v in items], "id long, v array<double>, load int")
    store = KeyedState(spark, str(tmp_path), rows(0, (1, [1.0])).schema, "id", ["load"])
    upsert_chunks(store, rows(1, (1, [1.0]), (2, [2.0]), (3, None)), "v", 1)
    upsert_chunks(store, rows(2, (1, [9.0]), (2, None)), "v", 2)
    assert got(store.current()) == [(1, [9.0], 2), (2, [2.0], 1)]
