"""Registry of named queries: a Spark callable and, where SQL can say it, the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables


@dataclass(frozen=True)
class Query:
    name: str
    rows: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.build(Tables(spark, directory))


REGISTRY: dict[str, Query] = {}


def query(name: str, *rows: str, sql: str | None = None):
    """Register a query under ``name``; ``rows`` are the inventory ids it covers."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, rows, build, sql)
        return build

    return wrap
