"""Keyed stream state: the last rows of every key, kept by the stream itself.

The rows of a key live in a list state (RocksDB with a changelog), so a batch reads and writes the
state of the keys it holds and no other. What a batch changes is stored as one row per changed key in
a bucketed table beside the stream (``sources.state``), where anybody reads the memory without
touching the stream.

With a time to live a key is forgotten once its newest row is older than that, by the newest event
time seen: the watermark trails the newest event time by the time to live, and an event-time timer
stands at every key's newest row. Rows older than the watermark are forgotten before they arrive.
Without it every row counts, however late.

A key with a third of all rows costs no more than others: every Arrow batch is cut to the last rows
per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from millrace.sources.state import KeyedState

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_MILLIS, _TIME = "__millis", "__time"


class LastRows(StatefulProcessor):
    """The last ``n`` rows of a key by ``order`` (largest first), given out whenever they change. If
    keys expire, a row's last column is its event time in milliseconds."""

    def __init__(self, names: list[str], kept: T.StructType, order: list[str], n: int, expires: bool):
        self.names, self.schema, self.n, self.expires = names, kept, n, expires
        self.width = len(names) - expires
        self.places = [names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("rows", self.schema)

    def _rank(self, row: tuple) -> tuple:
        return tuple((False,) if row[p] is None else (True, row[p]) for p in self.places)

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.kept.get()] if self.kept.exists() else []

    def _newest(self, rows: list[tuple]) -> int | None:
        return max((r[-1] for r in rows if r[-1] is not None), default=None)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = self._held()
        now = sorted([*held, *(tuple(row[c] for c in self.names) for row in rows)], key=self._rank, reverse=True)[: self.n]
        if now == held:
            return
        self.kept.put(now)
        if self.expires:
            before, newest = self._newest(held), self._newest(now)
            if newest != before:
                if before is not None:
                    self.handle.deleteTimer(before + 1)
                if newest is not None:
                    self.handle.registerTimer(newest + 1)
        yield Row(key=key[0], rows=[r[: self.width] for r in now])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        yield Row(key=key[0], rows=[])

    def close(self) -> None:
        pass


def _cut(key: str, order: list[str], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last ``n`` rows per key of every batch."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.take(pc.sort_indices(batch, [(c, "descending") for c in order], null_placement="at_end"))
            codes = rows.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            together = np.argsort(codes, kind="stable")
            first = np.searchsorted(codes[together], codes[together])
            yield rows.take(pa.array(np.sort(together[np.arange(len(codes)) - first < n])))

    return work


def _held_type(kind: T.DataType) -> T.DataType:
    """Times are held as microseconds, which no time zone of a worker changes."""
    return T.LongType() if isinstance(kind, T.TimestampType) else kind


def _memory_schema(rows: T.StructType, key: str) -> T.StructType:
    rest = T.StructType([T.StructField(f.name, _held_type(f.dataType)) for f in rows.fields if f.name != key])
    return T.StructType([T.StructField(key, rows[key].dataType), T.StructField("batch", T.LongType()), T.StructField("rows", T.ArrayType(rest))])


def _memory(spark: SparkSession, root: str, rows: T.StructType, key: str) -> KeyedState:
    return KeyedState(spark, root, _memory_schema(rows, key), key, ["batch"])


def remember_last(
    rows: DataFrame, key: str, order: list[str], n: int, root: str, checkpoint: str, trigger: dict,
    ts: str | None = None, ttl_hours: int | None = None,
) -> StreamingQuery:
    """Keep the last ``n`` rows per key (see the module); the memory is read with ``remembered``."""
    spark, schema = rows.sparkSession, rows.schema
    expires = ts is not None and ttl_hours is not None
    cut = rows.mapInArrow(_cut(key, order, n), schema)
    names = [c for c in rows.columns if c != key]
    held = [F.unix_micros(c).alias(c) if isinstance(schema[c].dataType, T.TimestampType) else F.col(c) for c in names]
    if expires:
        names.append(_MILLIS)
        held += [F.unix_millis(ts).alias(_MILLIS), F.col(ts).alias(_TIME)]
    timed = cut.select(key, *held)
    if expires:
        timed = timed.withWatermark(_TIME, f"{ttl_hours} hours")
    kept = T.StructType([T.StructField(c, timed.schema[c].dataType) for c in names])
    changed = timed.groupBy(key).transformWithState(
        LastRows(names, kept, order, n, expires),
        T.StructType([T.StructField("key", schema[key].dataType), _memory_schema(schema, key)["rows"]]), "update", "eventTime" if expires else "none",
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # A key may be given rows and be forgotten in one batch, as timers go by a later watermark than
        # late rows; timers come last, so of its two answers the empty one counts.
        last = batch.groupBy("key").agg(F.max(F.struct((F.size("rows") == 0).alias("gone"), "rows")).alias("last"))
        named = last.select(F.col("key").alias(key), F.lit(batch_id).cast("long").alias("batch"), "last.rows")
        _memory(batch.sparkSession, root, schema, key).put(named, batch_id)

    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        # A query takes the settings along when it starts.
        return changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def remembered(spark: SparkSession, root: str, rows: T.StructType, key: str) -> DataFrame:
    """The memory after the last finished batch, in the columns of ``rows``."""
    current = _memory(spark, root, rows, key).current().select(key, F.explode("rows").alias("__row"))
    shown = lambda f: F.timestamp_micros(F.col(f"__row.`{f.name}`")) if isinstance(f.dataType, T.TimestampType) else F.col(f"__row.`{f.name}`")
    return current.select(*[F.col(key) if f.name == key else shown(f).alias(f.name) for f in rows.fields])
