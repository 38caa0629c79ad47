"""Vectors in lists around centroids, searched exactly by leaving out what the triangle inequality rules out.

Centroids come from a bounded sample (``SAMPLE`` rows a list and ``FIT_CELLS`` numbers at most, the rows
with the smallest hashes of their ids); every row of the table is put into the list of its nearest
centroid. A list is stored in *cells* of at most ``CELL`` rows by distance from the centroid, so a
cell knows between which two radii its rows lie, and a list with a third of all rows is many cells.

For unit vectors q and x, a centroid c and a cell with radii r1..r2, the distance of q and x is at
least max(0, d(q, c) - r2, r1 - d(q, c)), and q.x = (|q|^2 + |x|^2 - d^2) / 2. So a cell's rows score
no more than (|q|^2 + 1 - bound^2) / 2. A search scores the ``FIRST`` most promising cells near each
query, which gives its ``k``-th best score so far, then only those lists and cells whose bound reaches
it. Queries meet cells in joins: no vector goes through the driver but the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.vectorsearch import _best, _unit, rank_hits, vector_dimension
from millrace.session import cut_lineage, shuffle_width

#: Rows of the sample a list, numbers of it in all, lists at most, rounds of the fit.
SAMPLE, FIT_CELLS, LISTS, ROUNDS = 64, 4_000_000, 4096, 6
#: Rows of a cell, queries that meet a cell at once, rows of a task when cells are scored.
CELL, QUERIES, ROWS_OF_TASK = 2048, 256, 64
#: Cells of a query scored before any is left out, and nearest lists they are taken from.
FIRST, NEAREST = 3, 2
#: Distances and scores are rounded sums.
SLACK = 1e-6


def _matrix(column: pa.Array, kind: type, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), size)


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(1)
    return np.sqrt(np.maximum(square, 0))


def fitted(rows: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of unit vectors by Lloyd's rounds from evenly spread rows; empty ones stay where they are."""
    centroids = rows[np.linspace(0, len(rows) - 1, min(lists, len(rows))).astype(int)].copy()
    for _ in range(ROUNDS):
        own = _distances(rows, centroids).argmin(1)
        count = np.bincount(own, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, own, rows)
        centroids[count > 0] = total[count > 0] / count[count > 0, None]
    return centroids


def _assigned(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CELL):
                part = batch.slice(at, CELL)
                raw = _matrix(part.column("v"), np.float32, centroids.shape[1])
                far = _distances(_unit(raw.astype("float64")), centroids)
                near = far.argmin(1)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(near, pa.int32()), pa.array(far[np.arange(len(near)), near]), pa.array([r.tobytes() for r in raw], pa.binary()),
                ], ["id", "list", "distance", "raw"])

    return work


def _cells(id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ordered rows as cells of one list each."""
    def cell(rows: pa.Table, number: int) -> pa.RecordBatch:
        distance = rows.column("distance").to_numpy()
        return pa.RecordBatch.from_pydict({
            "cell": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), "list": pa.array([rows.column("list")[0].as_py()], pa.int32()),
            "n": pa.array([len(distance)], pa.int64()), "low": pa.array([distance[0]]), "high": pa.array([distance[-1]]),
            "ids": pa.array([rows.column("id").to_pylist()], pa.list_(id_type)), "body": pa.array([b"".join(rows.column("raw").to_pylist())], pa.binary()),
        })

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, 0
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            lists = held.column("list").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(lists)) + 1).tolist(), len(lists)]
            done = 0
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                # The last list may go on in the next batch.
                for at in range(a, b, CELL):
                    if b < len(lists) or at + CELL < b:
                        done = min(at + CELL, b)
                        yield cell(held.slice(at, done - at), number)
                        number += 1
            held = held.slice(done)
        if held is not None and held.num_rows:
            yield cell(held, number)

    return work


def _placed(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Queries as unit vectors with their distance to every centroid."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                unit = _unit(_matrix(part.column("v"), np.float64, centroids.shape[1]).copy())
                far = _distances(unit, centroids)
                ends = pa.array(np.arange(len(unit) + 1) * far.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column("query_id"), pa.array((unit * unit).sum(1)), pa.array([u.tobytes() for u in unit], pa.binary()), pa.ListArray.from_arrays(ends, pa.array(far.ravel())),
                ], ["query_id", "square", "unit", "far"])

    return work


def _scored(size: int, k: int, query_type: pa.DataType, id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``k`` best rows of every cell for every query it meets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked = batch.column("asked")[row].as_py()
                ids = np.asarray(batch.column("ids")[row].as_py())
                rows = _unit(np.frombuffer(batch.column("body")[row].as_buffer(), np.float32).reshape(-1, size).astype("float64"))
                queries = np.stack([np.frombuffer(a["unit"], np.float64) for a in asked])
                # Twelve places: equal vectors tie wherever they lie.
                scores = np.round(queries @ rows.T, 12)
                best = [_best(own, ids, k) for own in scores]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array([a["query_id"] for a, own in zip(asked, best, strict=True) for _ in own], query_type),
                    "id": pa.array(ids[np.concatenate(best)].tolist(), id_type), "score": pa.array(np.concatenate([s[own] for s, own in zip(scores, best, strict=True)])),
                })

    return work


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StringType):
        return pa.string()
    if isinstance(kind, T.IntegralType):
        return pa.int64()
    raise TypeError(f"ids must be strings or integers, not {kind.simpleString()}")


def _id(column: Column, kind: T.DataType) -> Column:
    return column.cast("string" if isinstance(kind, T.StringType) else "long")


class VectorIndex:
    """A stored index: ``cells`` of vectors and their ``centroids``."""

    def __init__(self, cells: DataFrame, centroids: np.ndarray):
        self.cells, self.centroids = cells, centroids
        self.size = centroids.shape[1]

    @staticmethod
    def create(chunks: DataFrame, chunk_id: str, vector: str, root: str, lists: int | None = None, dimensions: int | None = None) -> VectorIndex:
        """Index every row whose vector is as long as most are (or ``dimensions``). ``lists`` grows with
        the square root of the rows unless it is given."""
        spark, base = chunks.sparkSession, root.rstrip("/")
        size = dimensions or vector_dimension(chunks, vector)
        kind = chunks.schema[chunk_id].dataType
        rows = chunks.filter(F.col(vector).isNotNull() & (F.size(vector) == size)).select(
            _id(F.col(chunk_id), kind).alias("id"), F.col(vector).cast("array<float>").alias("v")
        )
        n = rows.count()
        lists = min(LISTS, lists or max(1, round(n**0.5 / 2)))
        sample = min(lists * SAMPLE, max(lists, FIT_CELLS // max(size, 1)))
        taken = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
        centroids = fitted(_unit(np.array([r.v for r in taken], "float64").reshape(len(taken), size)), lists) if taken else np.zeros((1, size))
        id_type = rows.schema["id"].dataType.simpleString()
        assigned = rows.mapInArrow(_assigned(centroids), f"id {id_type}, list int, distance double, raw binary")
        order = ["list", "distance", "id"]
        parts = max(1, min(shuffle_width(spark), -(-n // CELL)), -(-n // (64 * CELL)))
        dealt = assigned.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        schema = f"cell bigint, list int, n bigint, low double, high double, ids array<{id_type}>, body binary"
        dealt.mapInArrow(_cells(_arrow(kind)), schema).write.mode("overwrite").parquet(f"{base}/cells")
        named = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
        spark.createDataFrame(named, "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{base}/centroids")
        return VectorIndex.read(spark, root)

    @staticmethod
    def read(spark: SparkSession, root: str) -> VectorIndex:
        base = root.rstrip("/")
        rows = spark.read.parquet(f"{base}/centroids").orderBy("list").collect()
        return VectorIndex(spark.read.parquet(f"{base}/cells"), np.array([r.centroid for r in rows], "float64"))

    def _queries(self, queries: DataFrame, query_id: str, vector: str) -> DataFrame:
        kind = queries.schema[query_id].dataType
        asked = queries.filter(F.col(vector).isNotNull() & (F.size(vector) == self.size)).select(
            _id(F.col(query_id), kind).alias("query_id"), F.col(vector).cast("array<double>").alias("v")
        )
        kind = asked.schema["query_id"].dataType.simpleString()
        return cut_lineage(asked.mapInArrow(_placed(self.centroids), f"query_id {kind}, square double, unit binary, far array<double>"), "queries")

    @staticmethod
    def _most(far: Column, low: Column, high: Column) -> Column:
        apart = F.greatest(F.lit(0.0), far - high, low - far)
        return (F.col("square") + 1 - apart * apart) / 2

    def _scores(self, pairs: DataFrame, placed: DataFrame, count: int, k: int) -> DataFrame:
        """(query_id, id, score) of the given (query_id, cell); queries meet a cell in blocks."""
        blocks = max(1, -(-count // QUERIES))
        dealt = pairs.join(placed.select("query_id", "unit"), "query_id").withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        groups = cut_lineage(dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("query_id", "unit")).alias("asked")), "meetings")
        parts = max(shuffle_width(placed.sparkSession), -(-groups.count() // ROWS_OF_TASK))
        met = groups.join(self.cells.select("cell", "ids", "body"), "cell").repartition(parts, "cell", "block")
        types = _arrow(placed.schema["query_id"].dataType), _arrow(self.cells.schema["ids"].dataType.elementType)
        schema = T.StructType([placed.schema["query_id"], T.StructField("id", self.cells.schema["ids"].dataType.elementType), T.StructField("score", T.DoubleType())])
        return met.select("asked", "ids", "body").mapInArrow(_scored(self.size, k, *types), schema)

    def opened(self, queries: DataFrame, k: int = 5, query_id: str = "query_id", vector: str = "vector") -> tuple[DataFrame, DataFrame]:
        """The pairs of query and cell that a search scores, and the scores."""
        placed = self._queries(queries, query_id, vector)
        count = placed.count()
        cells = self.cells.select("cell", "list", "low", "high")
        distances = placed.select("query_id", "square", F.posexplode("far").alias("list", "d"))
        nearest = rank_hits(distances.withColumn("near", -F.col("d")), "query_id", "list", "near", NEAREST).drop("near", "rank")
        bound = self._most(F.col("d"), F.col("low"), F.col("high"))
        first = nearest.join(cells, "list").withColumn("most", bound)
        first = cut_lineage(rank_hits(first, "query_id", "cell", "most", FIRST).select("query_id", "cell"), "first")
        found = cut_lineage(self._scores(first, placed, count, k), "found")
        least = rank_hits(found, "query_id", "id", "score", k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        wanted = distances.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)) - SLACK)
        lists = cells.groupBy("list").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        lists = wanted.join(lists, "list").filter(bound >= F.col("least")).drop("low", "high")
        rest = lists.join(cells, "list").filter(bound >= F.col("least")).select("query_id", "cell").join(first, ["query_id", "cell"], "left_anti")
        rest = cut_lineage(rest, "rest")
        return first.unionByName(rest), found.unionByName(self._scores(rest, placed, count, k))

    def search(self, queries: DataFrame, k: int = 5, query_id: str = "query_id", vector: str = "vector") -> DataFrame:
        """The ``k`` highest cosines per query as (query_id, id, score, rank), the smaller id first on ties."""
        return rank_hits(self.opened(queries, k, query_id, vector)[1], "query_id", "id", "score", k)
