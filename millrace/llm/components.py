"""Connected components of an edge table, with edges only ever in tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Edges that one task contracts.
EDGES_AT_ONCE = 500_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One half round: every node sends its neighbours (the larger or the smaller ones) to its least.

    A node's neighbours are never gathered: its least one is an aggregate that joins back."""
    seen = _both_ways(edges) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    met = seen.join(least, seen.a == least.node)
    if larger:
        out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one part as stars: every node with the least node it is connected with there."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (above := up.setdefault(root, root)) != root:
            root = above
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    stars = [(x, root) for x in list(up) if (root := find(x)) != x]
    yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in stars], pa.int64()), "b": pa.array([b for _, b in stars], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for every node of ``edges`` (a, b).

    Parts of at most ``EDGES_AT_ONCE`` edges are contracted to stars first, which leaves fewer edges
    than nodes a part. Large-star and small-star rounds then go on until nothing changes; each round
    is written, so a lost executor costs one round, and their number grows with the logarithm of the
    longest path."""
    edges = cut_lineage(edges.filter(F.col("a") != F.col("b")).select("a", "b"), "edges")
    parts = max(1, -(-edges.count() // EDGES_AT_ONCE))
    edges = cut_lineage(edges.repartition(parts).mapInArrow(_contracted, "a bigint, b bigint").distinct(), "edges")
    before = _digest(edges)
    while True:
        edges = cut_lineage(_star(_star(edges, larger=True), larger=False), "edges")
        after = _digest(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after


def _digest(edges: DataFrame) -> tuple:
    ends = (F.greatest("a", "b"), F.least("a", "b"))
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*ends)), F.sum(F.xxhash64(*ends) % 1_000_003)).first())
