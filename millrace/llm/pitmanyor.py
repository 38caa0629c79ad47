"""A hierarchical Pitman-Yor language model, sampled and scored where its counts lie.

The root restaurant serves words; below it every context (the word before, or the start of a text)
has a restaurant of its own, whose new tables are customers of the root. The base of the root gives
``UNSEEN`` to the one unseen type and shares the rest among the known words; discounts follow from
counts of counts.

Seating is sampled by blocked Gibbs sweeps: given the root's probabilities and the number of tables
of a context, the tables of every (context, word) are drawn anew by seating its customers one after
the other; then the root's tables are drawn. The score of a text uses predictive probabilities
averaged over the last sweeps.

How it runs. Texts are read in chunks of about ``CHUNK`` tokens; a chunk's distinct (context, word)
pairs go to buckets. At the end the texts are read again, as places in that list. Every rare
word has a home bucket: pairs that serve it lie there, and pairs of a frequent word in its context.
Pairs of two frequent words (at least 2**-``CONTEXT_LOG2`` of the training tokens, so at most
2**``CONTEXT_LOG2`` of them, and the end of a text) are dealt over all buckets. So the root's customers of a rare word are
known where it is served; sums of frequent words and contexts go between rounds into a table of at
most 2 * 2**``CONTEXT_LOG2`` rows on the driver. Customers and tables of a rare context are summed at
its home, which answers every bucket that holds some of its pairs. At the end every bucket answers
every chunk with the probabilities of the chunk's own pairs. All that moves grows with the distinct
pairs of the chunks and the tokens, never with their square; no task holds more than a chunk or a bucket.

Defined results: a null text is empty and holds its end alone; without training texts every token is
of the unseen type; repeated rows are scored each.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import PLAIN, binary_column, find_words, mix, packed, release, slices, unpacked
from millrace.session import cut_lineage, drop_scratch, free_shuffles, scratch, shuffle_width

CONTEXT_LOG2 = 16
CHUNK = 1 << 21
#: Tokens whose pairs meet in one bucket, about.
BUCKET = 1 << 21
ROUNDS = 2
SAMPLES = 3
CONCENTRATION = 1.0
UNSEEN = 0.5
#: Customers seated one by one; after them the next new table is drawn at once.
ONE_BY_ONE = 64

#: Codes of contexts: the start of a text, frequent words from ``OWN``; from ``HASHED`` on they are places
#: in a list of hashes that comes with the pairs.
START, OWN, HASHED = 0, 2, 1 << 20
END = mix(np.array([0x5EED], np.uint64))[0]
_PLANES = 5


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of a slice, the end of each text among them, and where each text begins."""
    words = find_words(data, offsets, PLAIN, lower=True)
    counts = np.diff(words.first) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(first[-1], END, np.uint64)
    is_word = np.ones(first[-1], bool)
    is_word[first[1:] - 1] = False
    out[is_word] = words.hashes()
    return out, first


def _chunks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray], dict[str, list]]]:
    """Tokens of about ``CHUNK`` tokens of whole texts, their tokens per text, and the named columns."""
    tokens, counts, kept, held = [], [], {n: [] for n in names}, 0
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            own, first = _tokens(data, offsets)
            tokens.append(own)
            counts.append(np.diff(first))
            for name in names:
                kept[name].append(part.column(name))
            held += len(own)
            if held >= CHUNK:
                yield np.concatenate(tokens), counts, kept
                tokens, counts, kept, held = [], [], {n: [] for n in names}, 0
    if held:
        yield np.concatenate(tokens), counts, kept


def _by_value(values: np.ndarray) -> dict[int, np.ndarray]:
    """Places of every distinct value, in order."""
    order = np.argsort(values, kind="stable")
    distinct, begins = np.unique(values[order], return_index=True)
    return dict(zip(distinct.tolist(), np.split(order, begins[1:]), strict=True)) if len(values) else {}


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tokens, _, _ in _chunks(batches, []):
        word, count = np.unique(tokens, return_counts=True)
        # A word with a share of 2**-16 overall reaches a quarter of it in the chunks that matter.
        keep = (count >= len(tokens) / (4 << CONTEXT_LOG2)) & (word != END)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(np.append(word[keep].view(np.int64), 0), pa.int64()),
            "n": pa.array(np.append(count[keep], 0), pa.int64()), "tokens": pa.array([0] * int(keep.sum()) + [len(tokens)], pa.int64()),
        })


class Layout(NamedTuple):
    """Frequent words (sorted hashes, ``END`` among them) and the number of buckets."""

    frequent: np.ndarray
    buckets: int

    def place(self, words: np.ndarray) -> np.ndarray:
        """Each word's place among the frequent ones, or -1."""
        if not len(self.frequent):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, at, -1)

    def home(self, words: np.ndarray) -> np.ndarray:
        """The bucket of a rare word, as a word and as a context."""
        return (mix(words) % np.uint64(self.buckets)).astype(np.int64)

    def bucket(self, words: np.ndarray, own: np.ndarray, contexts: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of pairs; ``before`` has the hashes of the contexts that are not frequent."""
        dealt = np.where(contexts >= HASHED, before, words ^ mix(contexts.astype(np.uint64) + np.uint64(1)))
        return self.home(np.where(own >= 0, dealt, words))


def _framed(counts: list[int], parts: list[bytes]) -> bytes:
    return np.array([*counts, *map(len, parts)], "<u8").tobytes() + b"".join(parts)


def _unframed(blob: bytes, n_counts: int, n_parts: int) -> tuple[list[int], list[bytes]]:
    head = np.frombuffer(blob, "<u8", n_counts + n_parts).tolist()
    cuts = np.cumsum([8 * len(head), *head[n_counts:]])
    return head[:n_counts], [blob[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _packed_sorted(hashes: np.ndarray) -> bytes:
    return packed(np.diff(hashes, prepend=np.uint64(0)), 8)


def _unpacked_sorted(blob: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpacked(blob, count, 8), dtype=np.uint64)


def _pairs_blob(words: np.ndarray, contexts: np.ndarray, counts: np.ndarray, hashes: np.ndarray | None = None) -> bytes:
    """Pairs in order of word: the words and the sorted ``hashes`` that the contexts from ``HASHED`` on mean
    as one list, the pairs of each, contexts and training counts."""
    hashes = np.zeros(0, np.uint64) if hashes is None else hashes
    named = np.union1d(words, hashes)
    far = contexts >= HASHED
    codes = contexts.copy()
    codes[far] = HASHED + np.searchsorted(named, hashes)[contexts[far] - HASHED]
    pairs = np.diff(np.searchsorted(words, named), append=len(words))
    return _framed([len(named), len(words)], [_packed_sorted(named), packed(pairs, 3), packed(codes, 4), packed(counts, _PLANES)])


def _read_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, contexts and counts of the pairs, and the hashes that the contexts from ``HASHED`` on mean."""
    (n_named, n_pairs), parts = _unframed(blob, 2, 4)
    named = _unpacked_sorted(parts[0], n_named)
    words = np.repeat(named, unpacked(parts[1], n_named, 3).astype(np.int64))
    contexts, counts = unpacked(parts[2], n_pairs, 4).astype(np.int64), unpacked(parts[3], n_pairs, _PLANES).astype(np.int64)
    far = contexts >= HASHED
    used, contexts[far] = np.unique(contexts[far] - HASHED, return_inverse=True)
    contexts[far] += HASHED
    return words, contexts, counts, named[used]


def _pair_rows(chunk: int, words: np.ndarray, word: np.ndarray, context: np.ndarray, count: np.ndarray, order: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
    """The pairs of a chunk, a row for each bucket that has some."""
    blobs, filled = [], np.flatnonzero(np.diff(cuts)).tolist()
    for b in filled:
        some = order[cuts[b] : cuts[b + 1]]
        codes = context[some]
        far = codes >= HASHED
        named, codes[far] = np.unique(codes[far] - HASHED, return_inverse=True)
        codes[far] += HASHED
        blobs.append(_pairs_blob(words[word[some]], codes, count[some], words[named]))
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array([chunk] * len(filled), pa.int64()), "bucket": pa.array(filled, pa.int32()), "pairs": pa.array(blobs, pa.binary()),
    })


def _chunk_rows(layout: Layout, key_type: pa.DataType | None = None):
    """With a ``key_type`` the texts of every chunk, their tokens as places among the chunk's pairs in
    order of bucket; without one those pairs. Both come from the same scan and agree in every chunk."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (tokens, counts, kept) in enumerate(_chunks(batches, ["key", "learn"])):
            sizes = np.concatenate(counts)
            learn = np.concatenate([c.to_numpy(zero_copy_only=False) for c in kept["learn"]]).astype(bool)
            words, at = np.unique(tokens, return_inverse=True)
            own = layout.place(words)
            context = np.full(len(tokens), START, np.int64)
            context[1:] = np.where(own >= 0, own + OWN, HASHED + np.arange(len(words)))[at[:-1]]
            context[np.cumsum(sizes)[:-1]] = START
            code, where = np.unique(at.astype(np.int64) << 32 | context, return_inverse=True)
            count = np.bincount(where[np.repeat(learn, sizes)], minlength=len(code))
            word, context = code >> 32, code & ((1 << 32) - 1)
            bucket = layout.bucket(words[word], own[word], context, words[np.maximum(context - HASHED, 0)])
            order = np.argsort(bucket, kind="stable")
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            cuts = np.searchsorted(bucket[order], np.arange(layout.buckets + 1))
            if key_type is None:
                yield _pair_rows(task << 32 | number, words, word, context, count, order, cuts)
                continue
            keys = pa.concat_arrays([c.cast(key_type) for c in kept["key"]])
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([task << 32 | number], pa.int64()), "tokens": pa.array([packed(back[where], 4)], pa.binary()),
                "keys": pa.array([keys.to_pylist()], pa.list_(key_type)), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
                "learn": pa.array([learn.tolist()], pa.list_(pa.bool_())),
            })

    return read


def _merge(table: pa.Table) -> pa.Table:
    """One row per bucket: its distinct pairs with counts, and where each chunk's pairs went."""
    release()
    table = table.sort_by("chunk")
    read = [_read_pairs(blob.as_py()) for blob in table.column("pairs")]
    words = np.concatenate([r[0] for r in read])
    hashes, named = np.unique(np.concatenate([r[3] for r in read]), return_inverse=True)
    begins = np.cumsum([0, *(len(r[3]) for r in read)])
    contexts = np.concatenate([r[1] + np.where(r[1] >= HASHED, begin, 0) for r, begin in zip(read, begins, strict=False)])
    contexts[contexts >= HASHED] = HASHED + named[contexts[contexts >= HASHED] - HASHED]
    counts = np.concatenate([r[2] for r in read])
    distinct, at = np.unique(words, return_inverse=True)
    code, where = np.unique(at.astype(np.int64) << 32 | contexts, return_inverse=True)
    total = np.bincount(where, counts, len(code)).astype(np.int64)
    code_contexts = code & ((1 << 32) - 1)
    merged = _pairs_blob(distinct[code >> 32], code_contexts, total, hashes)
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "pairs": pa.array([merged], pa.binary()),
        "chunks": pa.array([table.column("chunk").to_pylist()], pa.list_(pa.int64())),
        "sizes": pa.array([[len(r[0]) for r in read]], pa.list_(pa.int64())), "places": pa.array([packed(where, 4)], pa.binary()),
    })


class World(NamedTuple):
    """What all buckets share: by frequent context the customers and tables, by frequent word the root's
    customers (tables of all contexts), its own tables and the training count; totals; discounts."""

    customers: np.ndarray
    tables: np.ndarray
    served: np.ndarray
    root: np.ndarray
    counts: np.ndarray
    served_rare: int
    root_rare: int
    types: int
    tokens: int
    discount: float
    root_discount: float

    @property
    def known_base(self) -> float:
        return (1 - self.unseen_base) / max(1, self.types)

    @property
    def unseen_base(self) -> float:
        return UNSEEN if self.types else 1.0

    def root_probability(self, served: np.ndarray, tables: np.ndarray, base: np.ndarray | float) -> np.ndarray:
        all_served, all_tables = self.served.sum() + self.served_rare, self.root.sum() + self.root_rare
        new = (CONCENTRATION + self.root_discount * all_tables) * base
        return (np.maximum(served - self.root_discount * tables, 0) + new) / (CONCENTRATION + all_served)


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with the given customers, where a new table of the dish weighs ``strength``
    and a taken seat its customers less ``discount`` a table."""
    tables = (customers > 0).astype(np.int64)
    rows = np.flatnonzero(customers > 1)
    seated = 1
    while len(rows) and seated < ONE_BY_ONE:
        a, t = strength[rows], tables[rows]
        tables[rows] += rng.random(len(rows)) * (a + seated - discount * t) < a
        seated += 1
        rows = rows[customers[rows] > seated]
    at = np.full(len(rows), float(seated))
    while len(rows):
        # With x customers less discounts and weight a, no new table comes within m more with (x / (x + m)) ** a.
        x = np.maximum(at - discount * tables[rows], 1e-9)
        draw = -np.log(np.maximum(rng.random(len(rows)), 1e-300)) / np.maximum(strength[rows], 1e-12)
        at = at + np.ceil(x * np.expm1(np.minimum(draw, 60.0))) + 1
        go = at < customers[rows]
        tables[rows[go]] += 1
        rows, at = rows[go], at[go]
    return tables


class Bucket:
    """The pairs of a bucket, and its share of a Gibbs sweep."""

    def __init__(self, number: int, blob: bytes, layout: Layout, answers: dict[int, bytes] | None = None):
        self.number = number
        self.pair_words, self.contexts, self.counts, self.hashes = _read_pairs(blob)
        self.far = self.contexts >= HASHED
        self.homes = _by_value(layout.home(self.hashes))
        # Customers and tables of the rare contexts, as their homes gave them.
        self.far_customers, self.far_tables = np.zeros((2, len(self.hashes)), np.int64)
        for h, blob_of_home in (answers or {}).items():
            at = self.homes[h]
            _, parts = _unframed(blob_of_home, 1, 2)
            self.far_customers[at], self.far_tables[at] = (unpacked(part, len(at), _PLANES) for part in parts)
        self.words, self.of = np.unique(self.pair_words, return_inverse=True)
        self.own = layout.place(self.words)
        self.frequent = self.own[self.of] >= 0
        self.rare = self.own < 0
        self.word_counts = np.bincount(self.of, self.counts, len(self.words)).astype(np.int64)
        self.rng = np.random.Generator(np.random.PCG64([number, 11]))
        self.tables = (self.counts > 0).astype(np.int64)
        self._serve()
        self.root = (self.served > 0).astype(np.int64)

    def _serve(self) -> None:
        self.served = np.bincount(self.of, self.tables, len(self.words)).astype(np.int64)

    def _of_contexts(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Values of each pair's context, from those of the frequent and of the rare contexts."""
        return np.concatenate([near, far])[np.where(self.far, self.contexts - HASHED + len(near), self.contexts)]

    def probabilities(self, world: World) -> np.ndarray:
        """The root's probability of every word of the bucket."""
        at = np.maximum(self.own, 0)
        served, root, counts = self.served, self.root, self.word_counts
        if self.own.max(initial=-1) >= 0:
            served, root = np.where(self.rare, served, world.served[at]), np.where(self.rare, root, world.root[at])
            counts = np.where(self.rare, counts, world.counts[at])
        known = counts > 0
        p = world.root_probability(served, root, np.where(known, world.known_base, world.unseen_base))
        return p

    def sweep(self, world: World) -> None:
        p = self.probabilities(world)[self.of]
        strength = (CONCENTRATION + world.discount * self._of_contexts(world.tables, self.far_tables)) * p
        self.tables = seat(self.counts, strength, world.discount, self.rng)
        self._serve()
        all_tables = world.root.sum() + world.root_rare
        base = (CONCENTRATION + world.root_discount * all_tables) * world.known_base
        self.root = seat(np.where(self.rare, self.served, 0), np.full(len(self.words), base), world.root_discount, self.rng)

    def predictive(self, world: World) -> np.ndarray:
        p = self.probabilities(world)[self.of]
        held = np.maximum(self.counts - world.discount * self.tables, 0)
        new = (CONCENTRATION + world.discount * self._of_contexts(world.tables, self.far_tables)) * p
        return (held + new) / (CONCENTRATION + self._of_contexts(world.customers, self.far_customers))

    def asks(self) -> Iterator[tuple[int, bytes]]:
        """By home: this bucket's customers and tables of the home's contexts."""
        at = self.contexts[self.far] - HASHED
        customers, tables = (np.bincount(at, n[self.far], len(self.hashes)).astype(np.int64) for n in (self.counts, self.tables))
        for home, some in self.homes.items():
            parts = [_packed_sorted(self.hashes[some]), packed(customers[some], _PLANES), packed(tables[some], _PLANES)]
            yield home, _framed([len(some)], parts)

    def sums(self) -> dict[str, np.ndarray]:
        """Sums across buckets, as (kind, id, n): see ``_world``."""
        kinds, ids, ns = [], [], []

        def add(kind: int, at: np.ndarray, n: np.ndarray) -> None:
            total = np.bincount(at, n, int(at.max(initial=-1)) + 1).astype(np.int64)
            some = np.flatnonzero(total)
            kinds.append(np.full(len(some), kind))
            ids.append(some)
            ns.append(total[some])

        one = lambda n: (np.zeros(1, np.int64), np.array([n], np.int64))
        add(0, self.contexts[~self.far], self.counts[~self.far])
        add(1, self.contexts[~self.far], self.tables[~self.far])
        add(9, *one(self.counts[self.far].sum()))
        far = ~self.rare
        add(2, self.own[far], self.served[far])
        add(3, self.own[far], self.word_counts[far])
        add(4, *one(self.served[self.rare].sum()))
        add(5, *one(self.root[self.rare].sum()))
        add(6, *one((self.word_counts[self.rare] > 0).sum()))
        for kind, values in ((7, self.counts), (8, self.served[self.rare])):
            add(kind, np.array([1, 2]), np.array([(values == 1).sum(), (values == 2).sum()]))
        return {"kind": np.concatenate(kinds), "id": np.concatenate(ids), "n": np.concatenate(ns)}


def _swept(bucket: Bucket) -> pa.Table:
    """A bucket's sums for the world (``home`` is null) and what it asks the homes of its contexts."""
    sums, asked = bucket.sums(), list(bucket.asks())
    asks = {
        "home": pa.array([home for home, _ in asked], pa.int32()), "bucket": pa.array([bucket.number] * len(asked), pa.int32()),
        "totals": pa.array([blob for _, blob in asked], pa.binary()),
    }
    table = {k: pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(len(asked), pa.int64())]) for k, v in sums.items()}
    return pa.table(table | {k: pa.concat_arrays([pa.nulls(len(sums["n"]), v.type), v]) for k, v in asks.items()})


def _begun(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("bucket").to_pylist(), batch.column("pairs"), strict=True):
                yield from _swept(Bucket(number, blob.as_py(), layout)).to_batches()

    return run


def _answered(row: pa.Table, totals: pa.Table, layout: Layout) -> Bucket:
    release()
    answers = dict(zip(totals.column("home").to_pylist(), totals.column("totals").to_pylist(), strict=True))
    return Bucket(row.column("bucket")[0].as_py(), row.column("pairs")[0].as_py(), layout, answers)


def _sampled(layout: Layout, world: World, sweeps: int):
    def run(row: pa.Table, totals: pa.Table) -> pa.Table:
        bucket = _answered(row, totals, layout)
        for _ in range(sweeps):
            bucket.sweep(world)
        return _swept(bucket)

    return run


def _totals(table: pa.Table) -> pa.Table:
    """At a home: customers and tables of its contexts over all buckets, in the order each bucket asked."""
    asked = [_unframed(blob.as_py(), 1, 3) for blob in table.column("totals")]
    hashes, at = np.unique(np.concatenate([_unpacked_sorted(parts[0], n) for (n,), parts in asked]), return_inverse=True)
    sums = [np.bincount(at, np.concatenate([unpacked(parts[k], n, _PLANES) for (n,), parts in asked]), len(hashes)).astype(np.int64) for k in (1, 2)]
    cuts = np.cumsum([0, *(n for (n,), _ in asked)])
    blobs = [_framed([b - a], [packed(values[at[a:b]], _PLANES) for values in sums]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"bucket": table.column("bucket"), "home": table.column("home"), "totals": pa.array(blobs, pa.binary())})


def _answers(layout: Layout, world: World, burn: int):
    def run(row: pa.Table, totals: pa.Table) -> pa.Table:
        bucket = _answered(row, totals, layout)
        for _ in range(burn):
            bucket.sweep(world)
        total = np.zeros(len(bucket.counts))
        for _ in range(SAMPLES):
            bucket.sweep(world)
            total += bucket.predictive(world)
        log_p = np.log10(total / SAMPLES).astype(np.float32)
        seen = np.where(bucket.frequent, world.counts[np.maximum(bucket.own[bucket.of], 0)] if len(world.counts) else 0, bucket.word_counts[bucket.of])
        chunks, sizes = row.column("chunks")[0].as_py(), row.column("sizes")[0].as_py()
        where = unpacked(row.column("places")[0].as_py(), sum(sizes), 4).astype(np.int64)
        ends = np.cumsum([0, *sizes])
        parts = [where[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({
            "chunk": pa.array(chunks, pa.int64()), "bucket": pa.array([bucket.number] * len(parts), pa.int32()),
            "log_p": binary_column([pa.compress(log_p[w].tobytes(), codec="zstd", asbytes=True) for w in parts]),
            "seen": binary_column([packed(seen[w], _PLANES) for w in parts]), "size": pa.array([len(w) for w in parts], pa.int64()),
        })

    return run


def _scored(key_type: pa.DataType, train_tokens: int, types: int):
    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        answers = answers.sort_by("bucket")
        sizes = answers.column("size").to_pylist()
        log_p = np.concatenate([np.frombuffer(pa.decompress(b.as_py(), 4 * n, "zstd", asbytes=True), np.float32) for b, n in zip(answers.column("log_p"), sizes, strict=True)])
        seen = np.concatenate([unpacked(b.as_py(), n, _PLANES) for b, n in zip(answers.column("seen"), sizes, strict=True)]).astype(np.int64)
        row = {name: chunk.column(name)[0] for name in chunk.column_names}
        counts = np.array(row["sizes"].as_py(), np.int64)
        at = unpacked(row["tokens"].as_py(), int(counts.sum()), 4).astype(np.int64)
        begins = np.cumsum(counts) - counts
        base = np.log10((seen + 0.5) / (train_tokens + 0.5 * (types + 1)))
        return pa.table({
            "key": pa.array(row["keys"].values, key_type), "learn": pa.array(row["learn"].values, pa.bool_()),
            "n_tokens": pa.array(counts, pa.int64()), "n_known": pa.array(np.add.reduceat((seen > 0)[at], begins, dtype=np.int64), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base[at], begins), pa.float64()),
            "score": pa.array(np.add.reduceat(log_p[at].astype(np.float64), begins), pa.float64()),
        })

    return score


def _world(rows: list, layout: Layout, last: World | None) -> World:
    """Put the sums of all buckets together; the root's tables of frequent words are drawn here."""
    by_kind: dict[int, dict[int, int]] = {}
    for r in rows:
        by_kind.setdefault(r.kind, {})[r.id] = r.n

    def vector(kind: int, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        for at, n in by_kind.get(kind, {}).items():
            out[at] = n
        return out

    def discount(kind: int) -> float:
        once, twice = (by_kind.get(kind, {}).get(i, 0) for i in (1, 2))
        return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5

    size, own = len(layout.frequent), len(layout.frequent) + OWN
    customers, counts, served = vector(0, own), vector(3, size), vector(2, size)
    types = int((counts > 0).sum()) + by_kind.get(6, {}).get(0, 0)
    draft = World(
        customers, vector(1, own), served, (served > 0).astype(np.int64), counts, by_kind.get(4, {}).get(0, 0), by_kind.get(5, {}).get(0, 0),
        types, int(customers.sum()) + by_kind.get(9, {}).get(0, 0), last.discount if last else discount(7), last.root_discount if last else discount(8),
    )
    if last is None:
        return draft
    strength = (CONCENTRATION + draft.root_discount * (last.root.sum() + last.root_rare)) * draft.known_base
    drawn = seat(served, np.full(size, strength), draft.root_discount, np.random.Generator(np.random.PCG64(5)))
    return draft._replace(root=drawn)


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """``cut_lineage`` that keeps the rows dealt by ``bucket``: what joins them later moves, they do not."""
    spark = df.sparkSession
    path = scratch(spark, name)
    table = re.sub(r"\W", "_", os.path.basename(path))
    df.write.bucketBy(shuffle_width(spark), "bucket").option("path", path).saveAsTable(table)
    try:
        return spark.table(table).select("*")
    finally:
        spark.sql(f"DROP TABLE {table}")  # from the catalog; the files stay


def remainder(key) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 5


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: int = 1) -> DataFrame:
    """Per row: whether it was held out of training (crc32 of the id as text, modulo 5, is
    ``held_out``), tokens, known tokens, training tokens, the base score and the model's."""
    spark = docs.sparkSession
    part = (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5).cast("int")
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (part != held_out).alias("learn"))
    counted = source.filter("learn").select("text").mapInArrow(_frequent, "word bigint, n bigint, tokens bigint")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    total = (cut := cut_lineage(counted, "words")).agg(F.sum("tokens")).first()[0] or 0
    frequent = cut.filter((F.col("n") > 0) & (F.col("n") >= total / (1 << CONTEXT_LOG2))).select("word").collect()
    # Every text has an end: its pairs are dealt like those of a frequent word, however short the texts.
    words = np.sort(np.append(np.array([r.word for r in frequent], np.int64).view(np.uint64), END))
    layout = Layout(words, max(1, -(-total * 5 // (4 * BUCKET))))

    kind = docs.schema[key].dataType
    key_type = pa.string() if kind.typeName() == "string" else pa.int64()
    name = "string" if kind.typeName() == "string" else "bigint"
    # Pairs go from the texts into the shuffle; the texts are read again where the answers meet them.
    sent = source.mapInArrow(_chunk_rows(layout), "chunk bigint, bucket int, pairs binary")
    schema = "bucket int, pairs binary, chunks array<bigint>, sizes array<bigint>, places binary"
    state = _bucketed(sent.groupBy("bucket").applyInArrow(_merge, schema), "buckets")

    pairs = state.select("bucket", "pairs")
    schema = "kind bigint, id bigint, n bigint, home int, bucket int, totals binary"
    world, before = None, None
    for sweeps in range(ROUNDS + 1):
        if world is None:
            swept = pairs.mapInArrow(_begun(layout), schema)
        else:
            swept = pairs.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(_sampled(layout, world, sweeps), schema)
        path = scratch(spark, "swept")
        swept.write.parquet(path)
        if before:
            drop_scratch(spark, before)
        swept, before = spark.read.schema(schema).parquet(path), path
        free_shuffles(spark)
        world = _world(swept.filter("home IS NULL").groupBy("kind", "id").agg(F.sum("n").alias("n")).collect(), layout, world)
        asked = swept.filter("home IS NOT NULL").select("home", "bucket", "totals")
        totals = asked.groupBy("home").applyInArrow(_totals, "bucket int, home int, totals binary")
    schema = "chunk bigint, bucket int, log_p binary, seen binary, size bigint"
    replies = state.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(_answers(layout, world, ROUNDS), schema)
    held = source.mapInArrow(_chunk_rows(layout, key_type), f"chunk bigint, tokens binary, keys array<{name}>, sizes array<bigint>, learn array<boolean>")
    scored = held.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _scored(key_type, world.tokens, world.types), f"key {name}, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select(
        F.col("key").cast(kind).alias(key), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(world.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
