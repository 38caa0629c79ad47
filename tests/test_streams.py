"""A stream cut into several batches gives what one batch gives."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.features import FeatureView, current_features, serving_table
from millrace.operators.select import newest_per_key
from millrace.plans.relating import predictions
from millrace.plans.storing import VIEW
from millrace.session import Tables
from millrace.sources.schemas import SCHEMAS
from millrace.streaming import jobs


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    """``events`` as five files, out of time order, so that later batches hold older rows."""
    path = str(tmp_path_factory.mktemp("parts") / "events")
    Tables(spark, sf_dir).events.repartition(5, "event_id").write.parquet(path)
    return path


def stream(spark, parts):
    return jobs.file_stream(spark, parts, SCHEMAS["events"], files_per_batch=1)


def test_counts(spark, sf_dir, parts, tmp_path):
    query = jobs.running_counts(stream(spark, parts), f"{tmp_path}/out", f"{tmp_path}/cp")
    jobs.run_to_end(query)
    out = spark.read.schema("event_type string, count long, batch long").parquet(f"{tmp_path}/out")
    last = out.agg(F.max("batch")).first()[0]
    assert last == 4
    want = jobs.count_by_type(Tables(spark, sf_dir).events).collect()
    assert sorted(map(tuple, out.filter(F.col("batch") == last).drop("batch").collect())) == sorted(map(tuple, want))


def test_feature_push(spark, sf_dir, parts, tmp_path):
    jobs.run_to_end(jobs.push_features(stream(spark, parts), VIEW, f"{tmp_path}/out", f"{tmp_path}/cp"))
    events = Tables(spark, sf_dir).events
    got = serving_table(spark, VIEW, f"{tmp_path}/out", events).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, current_features(events, VIEW).collect()))


def test_last_rows_per_key(spark, sf_dir, parts, tmp_path):
    class Parts(Tables):
        def __getattr__(self, name):
            return stream(spark, parts)

    rows = predictions(Parts(spark, sf_dir))
    jobs.run_to_end(jobs.remember_last(rows, "model", ["ts", "event_id"], 20, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = jobs.remembered(spark, f"{tmp_path}/out", rows.schema, "model")
    want = newest_per_key(predictions(Tables(spark, sf_dir)), ["model"], [F.col("ts").desc(), F.col("event_id").desc()], 20)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_late_rows_are_corrections(spark, sf_dir, parts, tmp_path):
    """Files out of time order: what closed before, the late shares and the rest make up the batch's totals."""
    from millrace.plans.views import query_log

    class Parts(Tables):
        def __getattr__(self, name):
            return stream(spark, parts)

    out = f"{tmp_path}/out"
    jobs.run_to_end(jobs.corrected_analytics(query_log(Parts(spark, sf_dir)), out, f"{tmp_path}/cp"))
    place = lambda r: (r.window_start, r.tenant_id)
    shown = lambda df: {place(r): (r.queries, None if r.avg_ms is None else round(r.avg_ms, 6), r.max_ms) for r in df.collect()}
    batch = shown(jobs.window_totals(query_log(Tables(spark, sf_dir))))
    assert shown(jobs.complete_windows(spark, out)) == batch
    late, closed = jobs.corrections(spark, out).collect(), shown(jobs.closed_windows(spark, out))
    more = {}
    for r in late:
        more[place(r)] = more.get(place(r), 0) + r.queries
    # Only windows that had closed are corrected, and each correction completes its window.
    assert len(late) > 10 and len(closed) > 10
    assert all(batch[k][0] == closed.get(k, (0,))[0] + n for k, n in more.items())
    assert all(closed[k] == batch[k] for k in closed if k not in more)


def hourly(spark):
    """40 hours, a row each; key 3 falls silent after the eighth."""
    return spark.range(40).select((F.col("id") % 4).alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"), "id", F.array(F.col("id")).alias("a")).filter("k <> 3 OR id < 8")


def write_files(rows, path, files):
    rows.repartitionByRange(files, "id").sortWithinPartitions("id").write.mode("append").parquet(path)


def test_memory_is_bounded_and_expires(spark, tmp_path):
    write_files(hourly(spark), f"{tmp_path}/in", 5)
    stream = jobs.file_stream(spark, f"{tmp_path}/in", hourly(spark).schema, files_per_batch=1)
    jobs.run_to_end(jobs.remember_last(stream, "k", ["ts"], 3, f"{tmp_path}/out", f"{tmp_path}/cp", ts="ts", ttl_hours=20))
    kept = jobs.remembered(spark, f"{tmp_path}/out", hourly(spark).schema, "k")
    assert sorted((r.k, r.id, r.a) for r in kept.collect()) == [(k, i, [i]) for k in range(3) for i in range(28 + k, 40, 4)]


def test_a_key_filled_and_forgotten_in_one_batch_is_forgotten(spark, tmp_path):
    row = lambda k, hour: spark.range(1).select(F.lit(k).alias("k"), F.timestamp_seconds(F.lit(hour * 3600)).alias("ts"), F.lit(hour).alias("id"))
    for k, hour in ((0, 1), (0, 39), (3, 7)):
        write_files(row(k, hour), f"{tmp_path}/in", 1)
    stream = jobs.file_stream(spark, f"{tmp_path}/in", row(0, 0).schema, files_per_batch=1)
    jobs.run_to_end(jobs.remember_last(stream, "k", ["ts"], 3, f"{tmp_path}/out", f"{tmp_path}/cp", ts="ts", ttl_hours=20))
    kept = jobs.remembered(spark, f"{tmp_path}/out", row(0, 0).schema, "k")
    assert sorted((r.k, r.id) for r in kept.collect()) == [(0, 1), (0, 39)]


def test_a_batch_stores_the_keys_it_changes_and_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.sources.state.FAN", 100)
    rows = spark.range(400).select((F.col("id") / 40).cast("long").alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"), "id")
    late = spark.range(3).select(F.lit(0).cast("long").alias("k"), F.timestamp_seconds(F.lit(-5)).alias("ts"), (F.col("id") + 1000).alias("id"))
    for part in (rows.filter("id < 200"), rows.filter("id >= 200"), late):
        write_files(part, f"{tmp_path}/in", 1)
        stream = jobs.file_stream(spark, f"{tmp_path}/in", rows.schema, files_per_batch=1)
        jobs.run_to_end(jobs.remember_last(stream, "k", ["ts"], 3, f"{tmp_path}/out", f"{tmp_path}/cp"))
    memory = jobs.keyed._memory(spark, f"{tmp_path}/out", rows.schema, "k")
    stored = sorted((r.batch, r["count"]) for r in memory.rows().groupBy("batch").count().collect())
    # Five keys a batch; the late rows change nothing and store nothing.
    assert stored == [(0, 5), (1, 5)]
    kept = jobs.remembered(spark, f"{tmp_path}/out", rows.schema, "k")
    assert sorted((r.k, r.id) for r in kept.collect()) == [(k, 40 * k + 37 + i) for k in range(10) for i in range(3)]


def test_keys_without_a_value_have_a_memory_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1, "x"), (None, 2, None), ("a", None, "y"), ("a", 3, "z"), ("a", 3, "w")], "k string, o long, v string")
    rows.write.parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", rows.schema)
    jobs.run_to_end(jobs.remember_last(stream, "k", ["o", "v"], 2, f"{tmp_path}/out", f"{tmp_path}/cp"))
    kept = jobs.remembered(spark, f"{tmp_path}/out", rows.schema, "k")
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, 2, None), (None, 1, "x"), ("a", 3, "z"), ("a", 3, "w")], key=repr)


def test_trigger_is_the_callers(spark, parts, tmp_path):
    query = jobs.append_files(stream(spark, parts).select("event_id"), f"{tmp_path}/out", f"{tmp_path}/cp", trigger=jobs.every("1 second"))
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()


def test_late_older_rows_lose(spark, tmp_path):
    from millrace.operators.features import push

    view = FeatureView("v", "k", "ts", ("x",))
    row = lambda second, x: spark.range(1).select(F.lit("a").alias("k"), F.timestamp_seconds(F.lit(second)).alias("ts"), F.lit(x).alias("x"))
    push(row(100, 1), view, str(tmp_path), 0)
    push(row(50, 2), view, str(tmp_path), 1)
    assert serving_table(spark, view, str(tmp_path), row(0, 0)).first()["x"] == 1
