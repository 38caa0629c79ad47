"""Feature state: point-in-time reads, online look-ups, materialisation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import as_of_join
from millrace.sources.state import KeyedState, newest


@dataclass(frozen=True)
class FeatureView:
    """A feature table: entity key, event and created time, feature columns and time to live."""

    name: str
    key: str
    event_ts: str
    features: tuple[str, ...]
    created_ts: str | None = None
    ttl_seconds: int | None = None


def historical_features(entities: DataFrame, entity_ts: str, views: list[tuple[FeatureView, DataFrame]], bucket_seconds: int | None = None) -> DataFrame:
    """Entity rows with, per view, the features as they were known at the row's time. Time buckets are
    as narrow as the busiest key needs, unless ``bucket_seconds`` sets them."""
    out = entities
    for view, table in views:
        names = [f"{view.name}__{f}" for f in view.features]
        renamed = table.select(
            view.key, F.col(view.event_ts).alias("__ev"),
            *([F.col(view.created_ts).alias("__cr")] if view.created_ts else []),
            *[F.col(f).alias(n) for f, n in zip(view.features, names, strict=True)],
        )
        out = as_of_join(out, renamed, view.key, entity_ts, "__ev", names, "__cr" if view.created_ts else None, view.ttl_seconds, bucket_seconds)
    return out


def _version_order(view: FeatureView) -> list[str]:
    return [view.event_ts, view.created_ts] if view.created_ts else [view.event_ts]


def current_features(table: DataFrame, view: FeatureView) -> DataFrame:
    """The newest row per key; equal event times by the newest created time."""
    columns = [view.key, *_version_order(view), *view.features]
    return newest(table.select(*columns), view.key, _version_order(view))


def online_features(requests: DataFrame, online: DataFrame | KeyedState, view: FeatureView, now: Column | None = None, position: str = "position") -> DataFrame:
    """Requested keys in their order with the stored values; unknown or outlived keys get NULLs.
    Of a stored state only the requests are shuffled, to its buckets."""
    if isinstance(online, KeyedState):
        requests, online = requests.repartition(online.buckets, view.key), online.current()
    stored = online.select(F.col(view.key).alias("__k"), F.col(view.event_ts).alias("__ts"), *view.features)
    fresh = F.col("__ts").isNotNull()
    if view.ttl_seconds is not None and now is not None:
        fresh = fresh & (F.unix_micros(now) - F.unix_micros("__ts") <= view.ttl_seconds * 1_000_000)
    joined = requests.join(stored, requests[view.key] == stored["__k"], "left")
    return joined.select(position, requests[view.key], *[F.when(fresh, F.col(f)).alias(f) for f in view.features])


def materialise(table: DataFrame, view: FeatureView, start: str | None, end: str) -> DataFrame:
    """The newest row per key with start <= event time <= end."""
    rows = table.filter(F.col(view.event_ts) <= F.lit(end).cast("timestamp"))
    if start is not None:
        rows = rows.filter(F.col(view.event_ts) >= F.lit(start).cast("timestamp"))
    return current_features(rows, view)


def serving_state(spark: SparkSession, view: FeatureView, root: str, like: DataFrame) -> KeyedState:
    """The online rows of a view as a bucketed state; ``like`` has the columns' types."""
    schema = like.select(view.key, *_version_order(view), *view.features).schema
    return KeyedState(spark, root, schema, view.key, _version_order(view))


def push(rows: DataFrame, view: FeatureView, root: str, batch: int) -> None:
    """Append new values; only the newest of the batch per key is stored."""
    serving_state(rows.sparkSession, view, root, rows).put(rows, batch)


def serving_table(spark: SparkSession, view: FeatureView, root: str, like: DataFrame) -> DataFrame:
    """The online rows: per key the newest event time over all batches; late older rows lose."""
    return serving_state(spark, view, root, like).current()


def materialise_incremental(table: DataFrame, view: FeatureView, root: str, batch: int, last_end: str | None, end: str) -> str:
    """From the last end, or from ``ttl`` before the new end on the first run, up to ``end``.

    Returns the new high-water mark for the caller to store.
    """
    start = last_end
    if start is None and view.ttl_seconds is not None:
        start = table.sparkSession.range(1).select(
            (F.lit(end).cast("timestamp") - F.make_dt_interval(secs=F.lit(view.ttl_seconds))).cast("string")
        ).first()[0]
    push(materialise(table, view, start, end), view, root, batch)
    return end


def on_demand(requests: DataFrame, stored: DataFrame, key: str, outputs: dict[str, Column]) -> DataFrame:
    """Request columns joined with stored features, then formulas over both."""
    joined = requests.join(stored, key, "left")
    return reduce(lambda d, kv: d.withColumn(*kv), outputs.items(), joined)


# Derived features on request data.
CUSTOMER_DERIVED = {
    "balance_to_spend": lambda balance, spend: balance / (spend + 1),
    "is_loyal": lambda loyalty: F.when(loyalty > 0.8, 1).otherwise(0),
}
