"""Reading and writing tables: JDBC, CSV, snapshots, staging, versions and state."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- S1: databases ---------------------------------------------------------


def jdbc_reader(spark: SparkSession, url: str, table: str, partition_column: str, low: int, high: int, partitions: int, **options: str):
    """A reader for a table split on a numeric column, so that many executors fetch ranges at once."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high),
        numPartitions=str(partitions), pushDownPredicate="true", **options,
    )


def extract(table: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Named columns of a source table, handed on as parquet."""
    table.select(*columns).write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.select(*columns).schema).parquet(path)


# --- S3: CSV ---------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Header row, declared types; a bad cell fails the read instead of becoming NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def load_csv(spark: SparkSession, path: str, schema: str, out: str) -> DataFrame:
    """CSV to parquet; one row with the row and column counts of what was written."""
    df = read_csv(spark, path, schema)
    df.write.mode("overwrite").parquet(out)
    return spark.read.schema(df.schema).parquet(out).agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


# --- S4, S5, S7: snapshots -------------------------------------------------


def publish_snapshot(df: DataFrame, root: str, run_ts: str) -> str:
    """A new snapshot; an existing one is never replaced."""
    if not re.fullmatch(r"\d{8}_\d{6}", run_ts):
        raise ValueError("run_ts is yyyymmdd_hhmmss")
    path = f"{root.rstrip('/')}/snapshot_ts={run_ts}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _partitioned(spark: SparkSession, root: str, schema: str | T.StructType, partition: str) -> DataFrame:
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*declared.fields, T.StructField(partition, T.StringType())])
    return spark.read.schema(full).parquet(root)


def latest_snapshot(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """The newest snapshot. The newest name comes from the partition column alone, and the read
    that follows is pruned to it."""
    everything = _partitioned(spark, root, schema, "snapshot_ts")
    newest = everything.select("snapshot_ts").distinct().agg(F.max("snapshot_ts")).first()[0]
    return everything.filter(F.col("snapshot_ts") == newest).drop("snapshot_ts")


def list_days(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def day_extract(df: DataFrame, ts: str, day: str, key: str, limit: int | None = None) -> DataFrame:
    """Rows of one day; with a limit, the first ones in key order, so that the cut repeats."""
    start = F.lit(day).cast("timestamp")
    rows = df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day")))
    return rows if limit is None else rows.orderBy(key).limit(limit)


# --- S6, S11: incremental --------------------------------------------------


def interval_extract(df: DataFrame, ts: str, low: str, high: str) -> DataFrame:
    """low <= ts < high; a plain range on the raw column, so files and partitions are skipped."""
    return df.filter((F.col(ts) >= F.lit(low).cast("timestamp")) & (F.col(ts) < F.lit(high).cast("timestamp")))


def changed_since(df: DataFrame, ts: str, high_water: str | Column) -> DataFrame:
    mark = high_water if isinstance(high_water, Column) else F.lit(high_water).cast("timestamp")
    return df.filter(F.col(ts) > mark)


# --- S8, S9: staging -------------------------------------------------------


def stage(df: DataFrame, root: str, batch_id: str, created_at: str, value: str) -> None:
    """Rows land with batch id, load time and an exact two-place value. A repeated batch replaces itself."""
    staged = df.withColumns({"created_at": F.lit(created_at).cast("timestamp"), value: F.col(value).cast("decimal(10,2)")})
    staged.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")


def read_staging(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    return _partitioned(spark, root, schema, "batch_id")


def clean_staging(spark: SparkSession, root: str, schema: str | T.StructType, batch_id: str, as_of: str, out: str, days: int = 7, checks_passed: bool = True) -> DataFrame:
    """Staging without the batch's rows older than ``days``. Nothing is removed unless all checks passed.

    The kept rows are written beside the old ones and become current by path, so a lost
    executor or a failed job never leaves a half-cleaned table.
    """
    staged = read_staging(spark, root, schema)
    if checks_passed:
        cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"interval {days} days")
        staged = staged.filter(~((F.col("batch_id") == batch_id) & (F.col("created_at") < cutoff)))
    staged.write.partitionBy("batch_id").mode("overwrite").parquet(out)
    return read_staging(spark, out, schema)


# --- S13, S14: versions ----------------------------------------------------


def content_fingerprint(df: DataFrame) -> Column:
    """An order-free sum of row hashes: equal tables agree whatever their partitioning."""
    return F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string")


def register_version(df: DataFrame, root: str, version: str) -> None:
    """Data under ``data/version=<v>``, and one manifest row with rows, schema and fingerprint."""
    base = root.rstrip("/")
    df.write.mode("errorifexists").parquet(f"{base}/data/version={version}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{base}/data/version={version}")
    manifest = stored.agg(F.count(F.lit(1)).alias("rows"), content_fingerprint(stored).alias("fingerprint"))
    manifest = manifest.withColumn("schema_json", F.lit(json.dumps(df.schema.jsonValue())))
    manifest.write.mode("overwrite").parquet(f"{base}/manifest/version={version}")


MANIFEST = "rows long, fingerprint string, schema_json string"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return _partitioned(spark, f"{root.rstrip('/')}/manifest", MANIFEST, "version")


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The dataset as registered under ``version``, by its registered schema."""
    found = manifest(spark, root).filter(F.col("version") == version).select("schema_json").first()
    if found is None:
        raise ValueError(f"no version {version}")
    schema = T.StructType.fromJson(json.loads(found[0]))
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/data/version={version}")


def diff_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of each side that the other lacks, repeats counted."""
    gone = old.exceptAll(new).withColumn("change", F.lit("removed"))
    return gone.unionByName(new.exceptAll(old).withColumn("change", F.lit("added")))


# --- S15, S16, S17 ---------------------------------------------------------


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources under one schema, missing columns NULL, each row naming its source."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def append_results(results: DataFrame, root: str, run_id: str, run_ts: str, gate: Column | None = None) -> None:
    """Results of one run under their run id; a repeated run replaces itself."""
    stored = results.withColumns({"run_ts": F.lit(run_ts).cast("timestamp"), "gate_passed": gate if gate is not None else F.lit(None).cast("boolean")})
    stored.write.mode("overwrite").parquet(f"{root.rstrip('/')}/run_id={run_id}")


def read_results(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*declared.fields, T.StructField("run_ts", T.TimestampType()), T.StructField("gate_passed", T.BooleanType())])
    return _partitioned(spark, root, full, "run_id")


def export_user(tables: dict[str, tuple[DataFrame, str]], user_id: object) -> DataFrame:
    """Every row the tables hold on one user as (table_name, row_json) lines; write them with ``.write.text``."""
    parts = [
        df.filter(F.col(column) == F.lit(user_id)).select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("row_json"))
        for name, (df, column) in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
