"""Keyed state in Spark-bucketed files: batches append, the newest row per key counts.

A batch is a *run*: its newest row per key, dealt into the buckets of the state and sorted. All runs
of a state are one bucketed table, so reading the newest rows, looking keys up and merging runs need
no shuffle of the state; only requested keys and new rows move. ``FAN`` runs of a tier are merged
into one of the next, so the number of files stays with the logarithm of the batches and a row is
rewritten once a tier.

A run is written under its batch's id, so a batch that runs again replaces itself. A row that stands
in a merged run and in an old one counts once, so nothing is lost or doubled when a merge is cut
short. One writer a state; a reader whose files were merged away meanwhile has to read again. The
number of buckets is chosen when a state is made and kept with it.

Tables are declared under a passing name and dropped from the catalog at once; files stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import shuffle_width

#: Runs of one tier that are merged into one.
FAN = 4


def newest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key, by an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("__b"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


class KeyedState:
    """Rows of ``schema`` by ``key``; of two rows with one key the larger in ``order`` counts."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: list[str], buckets: int | None = None):
        self.spark, self.root, self.key, self.order = spark, root.rstrip("/"), key, order
        # A field's metadata would hinder the table's declaration.
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self.buckets = self._bucket_count(buckets)

    def _files(self, path: str):
        """The file system of ``path`` and the path, as the cluster sees them."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _bucket_count(self, wanted: int | None) -> int:
        fs, path = self._files(f"{self.root}/buckets")
        if not fs.exists(path):
            self.spark.range(1).select(F.lit(wanted or shuffle_width(self.spark)).cast("string")).coalesce(1).write.mode("overwrite").text(f"{self.root}/buckets")
        return int(self.spark.read.text(f"{self.root}/buckets").first()[0])

    def _tier(self, tier: int) -> str:
        return f"{self.root}/runs/tier={tier:02d}"

    def runs(self, tier: int) -> list[str]:
        """Paths of a tier's runs."""
        fs, path = self._files(self._tier(tier))
        return sorted(s.getPath().toString() for s in fs.listStatus(path) if not s.getPath().getName().startswith(("_", "."))) if fs.exists(path) else []

    def _tiers(self) -> int:
        fs, path = self._files(f"{self.root}/runs")
        return len(fs.listStatus(path)) if fs.exists(path) else 0

    def _declared(self, path: str) -> DataFrame:
        """All runs below ``path`` as one bucketed table."""
        fs, place = self._files(path)
        if not fs.exists(place):
            return self.spark.createDataFrame([], self.schema)
        name = f"state_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        try:
            return self.spark.table(name).select("*")
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _write(self, rows: DataFrame, path: str) -> None:
        name = f"state_{uuid.uuid4().hex}"
        try:
            rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).mode("overwrite").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def put(self, rows: DataFrame, batch: int) -> None:
        """Append a batch and merge what is due. Only the batch is shuffled."""
        rows = newest(rows.select(*self.schema.names), self.key, self.order)
        self._write(rows.repartition(self.buckets, self.key), f"{self._tier(0)}/batch={batch}")
        self.merge()

    def merge(self, everything: bool = False) -> None:
        """Merge every tier that holds ``FAN`` runs, or ``everything`` into one run."""
        tier = 0
        while tier < self._tiers():
            held = self.runs(tier)
            last = tier + 1 == self._tiers()
            if len(held) >= FAN or everything and (len(held) > 1 or held and not last):
                merged = newest(self._declared(self._tier(tier)), self.key, self.order)
                self._write(merged, f"{self._tier(tier + 1)}/merge={uuid.uuid4().hex}")
                for path in held:
                    fs, place = self._files(path)
                    fs.delete(place, True)
            tier += 1

    def rows(self) -> DataFrame:
        """All rows of all runs."""
        return self._declared(f"{self.root}/runs")

    def current(self) -> DataFrame:
        """The newest row per key, without a shuffle."""
        return newest(self.rows(), self.key, self.order)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Every row of ``requests`` with the state's columns, null where the key is unknown. The
        requests move to the state's buckets; the state stays where it is."""
        return requests.repartition(self.buckets, self.key).join(self.current(), self.key, "left")
