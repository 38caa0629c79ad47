"""Session settings, scratch locations and the table reader shared by every job."""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.schemas import SCHEMAS

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the submitter owns these settings."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("millrace")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only where the cluster names none (a local test) is a fresh folder made, and it is
    set on the session so that later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("millrace.shared.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("millrace.shared.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused location under this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/millrace-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything ``scratch`` and ``cut_lineage`` have written for this application. The job that
    owns the session calls it once its results are stored; frames still unread lose their inputs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one location that ``scratch`` gave, when nothing reads it any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now; it notices only when the
    driver collects its garbage, which on a quiet driver is every half hour."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a reliable cut that survives lost executors.
    The table stays until ``clear_scratch``."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan, dealt out over the cores when its files give fewer splits than there are.

    For work that costs far more than moving its input, on tables too small to split. A table
    with enough splits is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


class Tables:
    """Lazy reader: ``tables.orders`` is ``spark.read.parquet(<dir>/orders.parquet)``."""

    def __init__(self, spark: SparkSession, directory: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.directory = directory

    def path(self, name: str) -> str:
        return os.path.join(self.directory, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
