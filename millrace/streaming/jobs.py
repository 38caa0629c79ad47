"""Structured Streaming jobs. Every job takes a streaming frame, so Kafka, files or a rate source
all fit; sinks write under a batch id, so a replayed batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.contracts import split_dead_letters, validate_events
from millrace.operators.features import FeatureView, push
from millrace.operators.relate import recent_accuracy, share_of_classes
from millrace.streaming import keyed


def file_stream(spark: SparkSession, directory: str, schema: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream, with a declared schema and a bounded batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


#: Run over what is there and end; the other choice is ``every("10 seconds")``.
TO_THE_END = {"availableNow": True}


def every(interval: str) -> dict:
    """Run on and on, a batch each ``interval``."""
    return {"processingTime": interval}


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_batch: int | None = None) -> DataFrame:
    """A topic as (key, value) text rows, with a bound at most ``per_batch`` offsets per trigger. Needs the Kafka connector package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query and pass on its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- X1, X2: consume and publish -------------------------------------------


def parse_events(messages: DataFrame, value: str, schema: str) -> DataFrame:
    return messages.select(F.from_json(value, schema).alias("e")).select("e.*")


def count_by_type(events: DataFrame) -> DataFrame:
    """Counts per event type; a missing type counts as "unknown"."""
    return events.groupBy(F.coalesce("event_type", F.lit("unknown")).alias("event_type")).agg(F.count(F.lit(1)).alias("count"))


def running_counts(events: DataFrame, out: str, checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    """Current counts per type, replaced as a whole after every batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return count_by_type(events).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def as_messages(events: DataFrame, key: str) -> DataFrame:
    """(key, value) rows ready for a topic: the row as JSON, keyed by tenant."""
    return events.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(events: DataFrame, key: str, path: str, checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    """Messages to files; to a topic with ``format("kafka")`` in place of parquet."""
    return as_messages(events, key).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- X3, X8: analytics ------------------------------------------------------


def query_analytics(log: DataFrame, ts: str = "created_at", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Volume and latency per tenant and window; rows later than ``late`` are left out, as in any
    watermarked window. ``corrected_analytics`` keeps them."""
    return window_totals(log.withWatermark(ts, late), ts, width)


def window_totals(log: DataFrame, ts: str = "created_at", width: str = "1 hour") -> DataFrame:
    return log.groupBy(F.window(ts, width).alias("w"), "tenant_id").agg(
        F.count(F.lit(1)).alias("queries"), F.avg("latency_ms").alias("avg_ms"), F.max("latency_ms").alias("max_ms")
    ).select(F.col("w.start").alias("window_start"), "tenant_id", "queries", "avg_ms", "max_ms")


_PARTIAL = "window_start timestamp, tenant_id {tenant}, queries long, timed long, sum_ms double, max_ms double, late boolean, seen timestamp, batch long"


def corrected_analytics(
    log: DataFrame, root: str, checkpoint: str, ts: str = "created_at", width: str = "1 hour", late: str = "10 minutes", trigger: dict = TO_THE_END
) -> StreamingQuery:
    """The same totals with nothing lost: every batch stores its share of each window under its id. A
    share is late if its window had closed by the event times of the batches before: the newest of
    them less ``late`` had passed its end. Read it with ``closed_windows``, ``corrections`` and
    ``complete_windows``. Shares are sums per task before they move; a batch that runs again sees the
    same batches before it and replaces itself."""
    tenant = log.schema["tenant_id"].dataType.simpleString()

    def write(batch: DataFrame, batch_id: int) -> None:
        before = F.lit(None).cast("timestamp")
        if batch_id:
            stored = _shares(batch.sparkSession, root, tenant).filter(F.col("batch") < batch_id)
            before = F.lit(stored.agg(F.max("seen")).first()[0]).cast("timestamp")
        shares = batch.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, width).alias("w"), "tenant_id").agg(
            F.count(F.lit(1)).alias("queries"), F.count("latency_ms").alias("timed"), F.sum(F.col("latency_ms").cast("double")).alias("sum_ms"),
            F.max(F.col("latency_ms").cast("double")).alias("max_ms"), F.max(ts).alias("seen"),
        )
        closed = F.coalesce(F.col("w.end") <= before - F.expr(f"INTERVAL {late}"), F.lit(False))
        rows = shares.select(F.col("w.start").alias("window_start"), "tenant_id", "queries", "timed", "sum_ms", "max_ms", closed.alias("late"), "seen")
        rows.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return each_batch(log, write, checkpoint, trigger)


def _shares(spark: SparkSession, root: str, tenant: str) -> DataFrame:
    return spark.read.schema(_PARTIAL.format(tenant=tenant)).parquet(root)


def _merged_shares(shares: DataFrame) -> DataFrame:
    return shares.groupBy("window_start", "tenant_id").agg(
        F.sum("queries").alias("queries"), (F.sum("sum_ms") / F.nullif(F.sum("timed"), F.lit(0))).alias("avg_ms"), F.max("max_ms").alias("max_ms")
    )


def closed_windows(spark: SparkSession, root: str, width: str = "1 hour", late: str = "10 minutes", tenant: str = "bigint") -> DataFrame:
    """What a watermarked stream has given out: closed windows without their late rows."""
    shares = _shares(spark, root, tenant)
    passed = shares.agg(F.max("seen").alias("t")).select(F.col("t") - F.expr(f"INTERVAL {late}")).scalar()
    return _merged_shares(shares.filter(~F.col("late") & (F.col("window_start") + F.expr(f"INTERVAL {width}") <= passed)))


def corrections(spark: SparkSession, root: str, tenant: str = "bigint") -> DataFrame:
    """The late shares of windows that had closed: (window_start, tenant_id, queries, timed, sum_ms, max_ms, batch)."""
    return _shares(spark, root, tenant).filter("late").select("window_start", "tenant_id", "queries", "timed", "sum_ms", "max_ms", "batch")


def complete_windows(spark: SparkSession, root: str, tenant: str = "bigint") -> DataFrame:
    """All windows with all rows, late and open ones included."""
    return _merged_shares(_shares(spark, root, tenant))


def low_ratings(log: DataFrame, limit: int = 2) -> DataFrame:
    return log.filter(F.col("rating") <= limit)


def append_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- X4: dead letters -------------------------------------------------------


def dead_letter_split(messages: DataFrame, json: str, root: str, checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    """Valid and invalid events of every batch in one write under its batch id (see ``read_letters``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        split_dead_letters(validate_events(batch, json), f"{root}/batch={batch_id}")

    return each_batch(messages, write, checkpoint, trigger)


# --- X5: feature push -------------------------------------------------------


def push_features(rows: DataFrame, view: FeatureView, root: str, checkpoint: str, trigger: dict = TO_THE_END) -> StreamingQuery:
    """The newest row per key of each batch; readers take the newest over batches, so late older rows lose."""
    return each_batch(rows, lambda batch, batch_id: push(batch, view, root, batch_id), checkpoint, trigger)


# --- X6, X9: bounded memory per key ----------------------------------------


def remember_last(
    rows: DataFrame, key: str, order: list[str], n: int, root: str, checkpoint: str, trigger: dict = TO_THE_END,
    ts: str | None = None, ttl_hours: int | None = None,
) -> StreamingQuery:
    """Memory of the last ``n`` rows per key as keyed stream state: a batch touches the keys it holds
    and stores what changed. With ``ts`` and ``ttl_hours`` a key whose newest row is older than that,
    by the newest event time seen, is forgotten. See ``streaming.keyed``."""
    return keyed.remember_last(rows, key, order, n, root, checkpoint, trigger, ts, ttl_hours)


def remembered(spark: SparkSession, root: str, schema: T.StructType, key: str) -> DataFrame:
    """The memory after the last finished batch."""
    return keyed.remembered(spark, root, schema, key)


def live_sessions(memory: DataFrame, key: str, ts: str, now: str, ttl_hours: int = 24) -> DataFrame:
    """Sessions whose last write, by event time, is no older than the TTL."""
    alive = memory.groupBy(key).agg(F.max(ts).alias("__last")).filter(F.col("__last") >= F.lit(now).cast("timestamp") - F.expr(f"interval {ttl_hours} hours"))
    return memory.join(alive.select(key), key, "left_semi")


def monitor_report(memory: DataFrame, key: str, order: list[str], n: int = 100) -> DataFrame:
    """Rolling accuracy and the largest class share per model."""
    accuracy = recent_accuracy(memory, [key], [F.col(c).desc() for c in order], "predicted", "actual", n)
    skew = share_of_classes(memory, [key], "predicted").groupBy(key).agg(F.max("share").alias("max_share"))
    return accuracy.join(skew, key)


# --- X7: triggers -----------------------------------------------------------

# Which workflow an event starts, and the field its configuration carries.
TRIGGERS = {
    "new_data_arrived": ("data_processing_pipeline", "source"),
    "model_training_complete": ("model_deployment_pipeline", "model_id"),
}


def triggers(events: DataFrame, kind: str = "type", rules: dict[str, tuple[str, str]] = TRIGGERS) -> DataFrame:
    """(target, conf) rows for events a rule names; nothing is launched. The rules are part of the plan."""
    target = F.create_map(*[F.lit(x) for k, (t, _) in rules.items() for x in (k, t)])
    conf = None
    for name, (_, field) in rules.items():
        made = F.to_json(F.struct(F.col(field)))
        conf = F.when(F.col(kind) == name, made) if conf is None else conf.when(F.col(kind) == name, made)
    return events.filter(F.col(kind).isin(*rules)).select("*", target[F.col(kind)].alias("target"), conf.alias("conf"))
