"""Ranked lexical search: the best documents for every item, by branch and bound on document FP-trees.

Terms are runs of ASCII letters, digits and everything outside ASCII, with A-Z lower-cased. With N
documents that have a term, L terms in them, n in one of them, df documents that hold a term and tf
its occurrences in a document, a term weighs w = floor(1000 ln((2N+2) / (2df+1))), a document's m is
50 + 50 n N div L, and its score for an item is the sum of w * (10^9 tf div (1000 tf + 20 m)) over
the item's distinct terms. Only w is worked out in doubles; the rest is 64-bit integers.

One pass over the texts keeps each document's *restricted* term vector: the terms that some item
asks for. Each task then takes its vectors in blocks of ``DOCS`` and builds a tree of each block: a
vector's terms are ordered by document frequency, the rarest first, so that what weighs most decides
where a document goes; documents whose vectors begin alike share a path. Small siblings share a leaf,
long lists of siblings hang under span nodes. Every node knows, for each term below it, the largest
tf, and the least m. Both bound the score of any document below from above, since a term adds more
with a larger tf and a smaller m. Each item goes down the tree depth first, the most promising child
first, and leaves out every subtree whose bound is under its ``k``-th best score so far; a bound equal
to it is followed, as ties go by id. The best of all earlier blocks of the task stay with the item.

Items are searched in blocks of ``BLOCK_BYTES`` of terms, one pass each, so what goes to the tasks has
a bound. A task returns at most ``k`` rows an item; they are ranked in two steps, so no task meets all.

Terms stand as 64-bit hashes; two given different ones agree with probability 2^-64.

Defined cases: null, empty and term-less texts are in no count and no result; an item without terms
has no rows. Rows of items with one id (nulls alike) are one item with the terms of all. Equal scores
go by ascending id, a null id last, then in any order. Empty tables give an empty result. Other
columns are not read. Ids of documents are integers; others are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import ALNUM, find_words, slices
from millrace.session import cut_lineage

TOP = 50
#: Bytes of items' terms searched for in one pass.
BLOCK_BYTES = 4 << 20
#: Documents of a tree, and entries of their vectors.
DOCS, ENTRIES = 1 << 14, 1 << 22
#: Documents of a leaf, children of a node, terms of a path that are told apart.
LEAF, FAN, PATH = 48, 16, 12
#: First step of the final ranking: this many groups an item.
SALTS = 32


class Search(NamedTuple):
    """Items as places in ``vocabulary`` (sorted hashes): item i has ``terms[first[i]:first[i + 1]]``."""

    vocabulary: np.ndarray
    first: np.ndarray
    terms: np.ndarray


class Corpus(NamedTuple):
    """What all documents say: N, L, and by place in the vocabulary the weight and the frequency order."""

    documents: int
    length: int
    weight: np.ndarray
    order: np.ndarray


def _term_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            words = find_words(data, offsets, ALNUM, lower=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("item").take(pa.array(words.text_of())), pa.array(words.hashes().view(np.int64), pa.int64())], ["item", "term"]
            )


def _vectors(vocabulary: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                words = find_words(data, offsets, ALNUM, lower=True)
                hashes = words.hashes()
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[place] == hashes
                codes, tf = np.unique(words.text_of()[known] * len(vocabulary) + place[known], return_counts=True)
                rows, terms = np.divmod(codes, len(vocabulary))
                n = np.diff(words.first)
                cuts = pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32))
                out = pa.RecordBatch.from_arrays([
                    part.column("key"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(terms.astype(np.int32))),
                    pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int64))),
                ], ["key", "n", "terms", "tf"])
                yield out.filter(pa.array(n > 0))

    return work


def gain(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score; never less for a larger tf or a smaller m."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Tree:
    """A trie of the vectors of a block. Document d has the entries ``first[d]:first[d + 1]`` of
    ``term`` (ascending, the rarest is 0) and ``tf``; ``order`` says where it stood before."""

    def __init__(self, first: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray):
        sizes = np.diff(first)
        ended = int(term.max()) + 1 if len(term) else 1
        at = first[:-1, None] + np.arange(PATH)
        within = np.arange(PATH) < sizes[:, None]
        paths = np.where(within, term[np.where(within, at, 0)] if len(term) else 0, ended)
        self.order = np.lexsort(paths.T[::-1])
        paths, sizes = paths[self.order], sizes[self.order]
        moved = np.repeat(first[:-1][self.order], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.term, self.tf, self.m = term[moved], tf[moved], m[self.order]
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.root = self._grown(paths, 0, len(paths), 0)
        self._summed()

    def _node(self, span: tuple[int, int], children: list[int]) -> int:
        self.spans.append(span)
        self.children.append(children)
        return len(self.spans) - 1

    def _grown(self, paths: np.ndarray, low: int, high: int, depth: int) -> int:
        """The node of documents low:high, whose paths agree in their first ``depth`` terms."""
        while depth < PATH and high - low > LEAF and paths[low, depth] == paths[high - 1, depth]:
            depth += 1
        if depth == PATH or high - low <= LEAF:
            return self._node((low, high), [])
        runs = [low, *(np.flatnonzero(np.diff(paths[low:high, depth])) + 1 + low).tolist(), high]
        children, start = [], low
        for a, b in zip(runs[:-1], runs[1:], strict=True):
            if start < a and b - start > LEAF:
                children.append(self._node((start, a), []))
                start = a
            if b - a > LEAF:
                children.append(self._grown(paths, a, b, depth + 1))
                start = b
        if start < high:
            children.append(self._node((start, high), []))
        while len(children) > FAN:
            groups = [children[k : k + FAN] for k in range(0, len(children), FAN)]
            children = [self._node((self.spans[g[0]][0], self.spans[g[-1]][1]), g) if len(g) > 1 else g[0] for g in groups]
        return self._node((low, high), children)

    def _summed(self) -> None:
        """Per node the least m, and per (term, node) the largest tf, ordered by term."""
        nodes = len(self.spans)
        parent = np.full(nodes, -1)
        leaf_of = np.zeros(len(self.m), np.int64)
        self.least = np.full(nodes, np.iinfo(np.int64).max)
        for node, ((low, high), below) in enumerate(zip(self.spans, self.children, strict=True)):
            parent[below] = node
            if below:
                self.least[node] = self.least[below].min()
            else:
                leaf_of[low:high] = node
                self.least[node] = self.m[low:high].min()

        def largest(codes: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(codes, kind="stable")
            codes, tf = codes[order], tf[order]
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            return codes[starts], np.maximum.reduceat(tf, starts)

        if not len(self.term):
            self.peak_term, self.peak_node, self.peak = (np.zeros(0, np.int64),) * 3
            return
        codes, peak = largest(self.term * nodes + leaf_of[self.doc], self.tf)
        every = [(codes, peak)]
        while True:
            above = parent[codes % nodes]
            up = above >= 0
            if not up.any():
                break
            codes, peak = largest(codes[up] // nodes * nodes + above[up], peak[up])
            every.append((codes, peak))
        codes, self.peak = largest(np.concatenate([c for c, _ in every]), np.concatenate([p for _, p in every]))
        self.peak_term, self.peak_node = np.divmod(codes, nodes)

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> list[int]:
        """No document below a node scores more than this for an item's terms."""
        low, high = np.searchsorted(self.peak_term, terms), np.searchsorted(self.peak_term, terms, "right")
        size = high - low
        at = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        node = self.peak_node[at]
        bound = np.zeros(len(self.spans), np.int64)
        np.add.at(bound, node, gain(np.repeat(weight, size), self.peak[at], self.least[node]))
        return bound.tolist()

    def scores(self, low: int, high: int, weight: np.ndarray) -> np.ndarray:
        """Scores of documents low:high; ``weight`` is by term, zero for terms the item lacks."""
        a, b = self.first[low], self.first[high]
        mine = weight[self.term[a:b]]
        hit = np.flatnonzero(mine)
        doc = self.doc[a:b][hit]
        out = np.zeros(high - low, np.int64)
        np.add.at(out, doc - low, gain(mine[hit], self.tf[a:b][hit], self.m[doc]))
        return out


class Best:
    """The ``k`` best documents of one item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.key, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """Below this nothing enters."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, key: np.ndarray, known: np.ndarray) -> None:
        score, key, known = np.concatenate([self.score, score]), np.concatenate([self.key, key]), np.concatenate([self.known, known])
        order = np.lexsort([key, ~known, -score])[: self.k]
        self.score, self.key, self.known = score[order], key[order], known[order]


def descend(tree: Tree, best: Best, terms: np.ndarray, weights: np.ndarray, by_term: np.ndarray, key: np.ndarray, known: np.ndarray) -> int:
    """Depth-first search of one item in one tree; returns the number of documents it looked at."""
    bound, seen = tree.bounds(terms, weights), 0
    stack = [tree.root]
    while stack:
        node = stack.pop()
        if bound[node] < best.least:
            continue
        if tree.children[node]:
            stack.extend(sorted(tree.children[node], key=bound.__getitem__))
            continue
        low, high = tree.spans[node]
        seen += high - low
        score = tree.scores(low, high, by_term)
        good = np.flatnonzero(score >= best.least)
        if len(good):
            best.add(score[good], key[low + good], known[low + good])
    return seen


def _searched(search: Search, corpus: Corpus, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    order = corpus.order.astype(np.int64)
    weight = np.zeros(len(order), np.int64)
    weight[order] = corpus.weight

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, docs, entries = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ends = np.cumsum(batch.column("terms").slice(at).value_lengths().to_numpy(zero_copy_only=False))
                take = max(1, min(DOCS - docs, int(np.searchsorted(ends, ENTRIES - entries))))
                part = batch.slice(at, take)
                held.append(part)
                docs, entries, at = docs + part.num_rows, entries + int(ends[part.num_rows - 1]), at + take
                if docs >= DOCS or entries >= ENTRIES:
                    yield pa.Table.from_batches(held)
                    held, docs, entries = [], 0, 0
        if held:
            yield pa.Table.from_batches(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in range(len(search.first) - 1)]
        by_term = np.zeros(len(order), np.int64)
        for block in blocks(batches):
            block = block.combine_chunks()
            vectors = block.column("terms").combine_chunks()
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            term = order[vectors.flatten().to_numpy(zero_copy_only=False)]
            tf = block.column("tf").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            sort = np.argsort(rows * len(order) + term)
            m = 50 + (50 * block.column("n").to_numpy() * corpus.documents) // corpus.length
            tree = Tree(np.concatenate([[0], np.cumsum(sizes)]), term[sort], tf[sort], m)
            key = block.column("key").combine_chunks()
            known = key.is_valid().to_numpy(zero_copy_only=False)[tree.order]
            key = key.fill_null(0).to_numpy(zero_copy_only=False)[tree.order]
            for k_item, own in enumerate(best):
                terms = order[search.terms[search.first[k_item] : search.first[k_item + 1]]]
                by_term[terms] = weight[terms]
                descend(tree, own, terms, weight[terms], by_term, key, known)
                by_term[terms] = 0
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        if len(item):
            key = pa.array(np.concatenate([b.key for b in best]), pa.int64(), mask=~np.concatenate([b.known for b in best]))
            score = pa.array(np.concatenate([b.score for b in best]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), key, score], ["place", "key", "score"])

    return work


def _block(docs: DataFrame, asked: DataFrame, block: int, k: int, item_type: T.DataType) -> DataFrame | None:
    """``item``, ``key`` and ``score`` of the best documents of every task, for the items of one block."""
    spark = docs.sparkSession
    rows = asked.filter(F.col("block") == block).groupBy("item").agg(F.collect_list("term").alias("terms")).collect()
    if not rows:
        return None
    flat = np.array([t for r in rows for t in r.terms], np.int64).view(np.uint64)
    vocabulary = np.unique(flat)
    search = Search(vocabulary, np.cumsum([0, *(len(r.terms) for r in rows)]), np.searchsorted(vocabulary, flat))
    vectors = cut_lineage(docs.mapInArrow(_vectors(vocabulary), "key bigint, n bigint, terms array<int>, tf array<bigint>"), "vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    if not total.documents:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r.term] = r["count"]
    weight = np.floor(1000 * np.log((2 * total.documents + 2) / (2 * df + 1))).astype(np.int64)
    order = np.empty(len(df), np.int64)
    order[np.lexsort([np.arange(len(df)), df])] = np.arange(len(df))
    found = vectors.mapInArrow(_searched(search, Corpus(total.documents, total.length, weight, order), k), "place int, key bigint, score bigint")
    names = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], T.StructType([T.StructField("place", T.IntegerType()), T.StructField("item", item_type)]))
    return found.join(names, "place").select("item", "key", "score")


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = TOP) -> DataFrame:
    """The ``k`` best documents of every item: ``item``, ``rank`` (from 1), ``key`` and ``score`` (above 0)."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    if not isinstance(source.schema["key"].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer, it is {source.schema['key'].dataType.simpleString()}")
    source = source.withColumn("key", F.col("key").cast("long"))
    asked = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    kind = asked.schema["item"].dataType
    asked = cut_lineage(asked.mapInArrow(_term_hashes, f"item {kind.simpleString()}, term bigint").distinct(), "asked")
    blocks = max(1, -(-8 * asked.count() // BLOCK_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = [f for b in range(blocks) if (f := _block(source, asked, b, k, kind)) is not None]
    if not found:
        return spark.createDataFrame([], T.StructType([
            T.StructField(item, kind), T.StructField("rank", T.IntegerType()), T.StructField(key, T.LongType()), T.StructField("score", T.LongType()),
        ]))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best_first = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    part = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    some = every.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best_first)))
    ranked = some.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best_first)))
    return ranked.filter(F.col("rank") <= k).select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
