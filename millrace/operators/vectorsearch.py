"""Exact vector search over a chunk table, upserts and diversity reranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.select import newest_per_key
from millrace.session import cut_lineage
from millrace.sources.state import KeyedState

# Numbers (rows times dimensions) of a block of queries, about: what travels to every task.
BROADCAST_CELLS = 4_000_000
# Scores held at once: this many queries against one batch of chunks.
TILE = 512


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score desc, id asc)."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _search_batches(batches: Iterator[pd.DataFrame], query_ids: list, queries: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """Running top-k per query over the batches of one task."""
    ids, scores = [None] * len(query_ids), [None] * len(query_ids)
    for batch in batches:
        if batch.empty:
            continue
        units = _unit(np.stack(batch["v"].to_numpy()).astype("float64")).T
        new_ids = np.asarray(batch["id"].tolist())
        for low in range(0, len(query_ids), TILE):
            # Twelve places: equal vectors tie wherever they sit in a batch.
            found = np.round(queries[low:low + TILE] @ units, 12)
            for q in range(low, low + len(found)):
                row = found[q - low]
                all_ids = new_ids if ids[q] is None else np.concatenate([ids[q], new_ids])
                all_scores = row if scores[q] is None else np.concatenate([scores[q], row])
                top = _best(all_scores, all_ids, k)
                ids[q], scores[q] = all_ids[top], all_scores[top]
    for q, query_id in enumerate(query_ids):
        if ids[q] is not None:
            kept = pd.Series(ids[q].tolist(), dtype=object if ids[q].dtype.kind == "U" else ids[q].dtype)
            asked = pd.Series([query_id] * len(kept), dtype=object if isinstance(query_id, str) else None)
            yield pd.DataFrame({"query_id": asked, "id": kept, "score": scores[q]})


def vector_dimension(chunks: DataFrame, vector: str) -> int:
    """The length most of a table's vectors have; 0 for a table without vectors."""
    sizes = chunks.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max_by("size", F.struct("n", "size"))).first()
    return row[0] or 0


def rejected_vectors(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """(key, size) of the rows a search cannot use: no vector (size NULL) or one of another length."""
    size = F.when(F.col(vector).isNotNull(), F.size(vector))
    return df.select(key, size.alias("size")).filter(F.col("size").isNull() | (F.col("size") != dimensions))


def cosine_top_k(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vector: str = "vector",
    chunk_id: str = "chunk_id",
    chunk_vector: str = "vector",
    dimensions: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """The ``k`` highest cosines per query as (query_id, id, score, rank), the smaller id first on ties.

    Queries travel in blocks of at most ``BROADCAST_CELLS`` numbers and the chunk table is read in
    place, once a block; each task keeps its own top-k per query, so at most k rows per query and
    task are shuffled. Of several blocks one is held at a time: its hits are written before the next
    is read. ``blocks`` asks for more blocks than that. For a table that is searched again and again,
    or queries by the million, there is ``vectorindex``. Vectors are as long as most of the
    chunk table's, or ``dimensions``; see ``rejected_vectors`` for rows that are not.
    """
    size = dimensions or vector_dimension(chunks, chunk_vector)
    q = queries.filter(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("v"))
    q = q.filter(F.size("v") == size)
    c = chunks.filter(F.col(chunk_vector).isNotNull() & (F.size(chunk_vector) == size)).select(
        F.col(chunk_id).alias("id"), F.col(chunk_vector).cast("array<float>").alias("v")
    )
    schema = T.StructType([q.schema["query_id"], c.schema["id"], T.StructField("score", T.DoubleType())])
    held = max(1, BROADCAST_CELLS // max(size, 1))
    count = max(blocks or 1, -(-q.count() // held))
    if count > 1:
        q = cut_lineage(q.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(count))), "queries")

    def against(block: DataFrame) -> tuple[DataFrame, Broadcast]:
        rows = block.orderBy("query_id").collect()
        query_ids = [r["query_id"] for r in rows]
        matrix = _unit(np.array([r["v"] for r in rows], dtype="float64").reshape(len(rows), size))
        shared = chunks.sparkSession.sparkContext.broadcast((query_ids, matrix))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _search_batches(batches, *shared.value, k)

        return c.mapInPandas(search, schema), shared

    if count == 1:
        return rank_hits(against(q)[0], "query_id", "id", "score", k)
    partial = []
    for i in range(count):
        found, shared = against(q.filter(F.col("block") == i).drop("block"))
        partial.append(cut_lineage(found, "block_hits"))
        shared.destroy()
    return rank_hits(reduce(DataFrame.unionByName, partial), "query_id", "id", "score", k)


def rank_hits(hits: DataFrame, query: str, key: str, score: str, k: int) -> DataFrame:
    """Best ``k`` per query with their rank from 1."""
    from pyspark.sql import Window

    window = Window.partitionBy(query).orderBy(F.col(score).desc(), F.col(key))
    return hits.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def upsert(state: DataFrame, batch: DataFrame, key: str, vector: str, order: str) -> DataFrame:
    """State after a batch: the last write per id wins, rows without a vector are skipped."""
    rows = state.unionByName(batch).filter(F.col(vector).isNotNull())
    return newest_per_key(rows, [key], [F.col(order).desc()])


def upsert_chunks(store: KeyedState, rows: DataFrame, vector: str, batch: int) -> None:
    """The same on a stored state: only the batch is shuffled."""
    store.put(rows.filter(F.col(vector).isNotNull()), batch)


def delete_document(state: DataFrame, documents: DataFrame, document: str) -> DataFrame:
    """State without any chunk of the given documents."""
    return state.join(documents.select(document).distinct(), document, "left_anti")


def collection_stats(state: DataFrame, document: str, vector: str) -> DataFrame:
    return state.agg(
        F.count(F.lit(1)).alias("points"), F.count_distinct(document).alias("documents"),
        F.min(F.size(vector)).cast("long").alias("min_dimensions"), F.max(F.size(vector)).cast("long").alias("max_dimensions"),
    )


def mmr(hits: DataFrame, queries: DataFrame, vectors: DataFrame, k: int = 5, weight: float = 0.7) -> DataFrame:
    """Maximal marginal relevance: greedily the candidate with the best mix of closeness to the
    query and distance from what is already picked. The first pick counts as fully diverse.

    A group is one query's candidates, as many as the search before it returned.
    """
    rows = hits.join(vectors.select("id", F.col("vector").alias("v")), "id").join(queries.select("query_id", F.col("vector").alias("q")), "query_id")

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rank", "id"])
        docs = _unit(np.stack(pdf["v"].to_numpy()).astype("float64"))
        relevance = docs @ _unit(np.asarray([pdf["q"].iloc[0]], dtype="float64"))[0]
        closest = np.zeros(len(pdf))
        free = np.ones(len(pdf), dtype=bool)
        chosen, scores = [], []
        while len(chosen) < min(k, len(pdf)):
            mix = weight * relevance + (1 - weight) * (1 - closest)
            mix[~free] = -np.inf
            best = int(np.argmax(mix))
            scores.append(mix[best])
            chosen.append(best)
            free[best] = False
            similarity = docs @ docs[best]
            closest = similarity if len(chosen) == 1 else np.maximum(closest, similarity)
        return pd.DataFrame({
            "query_id": pdf["query_id"].iloc[0], "id": pdf["id"].to_numpy()[chosen], "pick": np.arange(1, len(chosen) + 1), "mmr": scores,
        })

    return rows.select("query_id", "id", "rank", "v", "q").groupBy("query_id").applyInPandas(
        pick, T.StructType([rows.schema["query_id"], rows.schema["id"], T.StructField("pick", T.LongType()), T.StructField("mmr", T.DoubleType())])
    )


def missing_document_probe(hits: DataFrame, wanted: DataFrame, query: str, key: str, document: str, late: int = 10) -> DataFrame:
    """For every (query, document): chunks held, best score and best rank among the hits, and
    whether the document is absent or ranked beyond ``late``.

    ``wanted`` is (query, document, chunk key) rows of the documents under suspicion.
    """
    seen = hits.select(F.col(query).alias("__q"), F.col(key).alias("__k"), "score", "rank")
    joined = wanted.join(seen, (F.col(query) == F.col("__q")) & (F.col(key) == F.col("__k")), "left")
    return joined.groupBy(query, document).agg(
        F.count(F.lit(1)).alias("chunks"), F.max("score").alias("best_score"), F.min("rank").cast("long").alias("best_rank")
    ).withColumn("missing", F.coalesce(F.col("best_rank") > late, F.lit(True)))


Scorer = Callable[[pd.Series, pd.Series], pd.Series]


def rerank(candidates: DataFrame, scorer, k: int = 5, query: str = "query_id", key: str = "id", question: str = "question", text: str = "text") -> DataFrame:
    """Replace every candidate's score by ``scorer(question, text)`` and keep the best ``k`` per query.

    ``scorer`` is any function of two columns: a native expression or a pandas UDF. Fetch 2k
    candidates before calling this.
    """
    scored = candidates.withColumn("score", scorer(F.col(question), F.col(text))).drop("rank")
    return rank_hits(scored, query, key, "score", k)


def skip_rerank(queries: DataFrame, question: str, top_score: str) -> DataFrame:
    """No rerank for a confident top hit or a question under five words."""
    from millrace.functions.text import words

    return queries.withColumn(
        "should_rerank",
        ~((F.coalesce(F.col(top_score), F.lit(0.0)) > 0.9) | (F.size(words(F.col(question))) < 5)),
    )
