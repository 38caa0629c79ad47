"""Token ids as files: canonical, length-limited Huffman codes in blocks that decode on their own.

A store is a folder with two Parquet tables. ``codebook`` has the code length of every id that
occurs; lengths come from the counts over all documents (package-merge, so none is longer than the
limit) and canonical codes follow from the lengths alone. ``blocks`` has one row per block: the keys
of its documents, in ascending key order, and a byte string of unsigned little-endian numbers and codes:

    4 bytes   number of documents
    4 bytes   number of checkpoints
    4 each    ids of every document
    4 each    checkpoints: the bit offset of every ``CHECKPOINT``-th id of every document
    the rest  codes, first bit highest; every document begins a byte

Decoding looks up ``limit`` bits at a time in one table and runs from all checkpoints of a block at
once. ``part`` and ``first`` place a block: parts are in key order, and ``first`` counts the ids of
the part before the block. Documents are coded before they move, so what is shuffled is as small as
the store.

Defined results: a null text is empty and holds its end id alone; rows with a null key come first;
rows with equal keys follow each other by content; keys are numbers; an empty table gives an empty
store.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import binary_column
from millrace.llm.tokens import encoded
from millrace.operators.ordered import bucket_by_order
from millrace.session import scratch

#: Longest code in bits; raised only if the vocabulary needs more.
LIMIT = 16
CHECKPOINT = 64
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 18
#: Ids coded together.
AT_ONCE = 1 << 16


def planes(ids: np.ndarray) -> bytes:
    """Ids as byte planes, least first, after their number: neighbours in a plane compress well."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    width = raw[0]
    out = np.zeros(((len(raw) - 1) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, -1, 1).reshape(width, -1).T
    return out.view("<u4").ravel()


def token_ids(docs: DataFrame, key: str, text: str, path: str, end_id: int, blank_matters: bool = False) -> DataFrame:
    """``key`` and ``ids`` (see ``planes``; the end id last) of every text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, ends in encoded(batches, path, blank_matters):
            rows = [planes(np.append(ids[ends[i] : ends[i + 1]], end_id)) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_pydict({"key": part.column("key"), "ids": binary_column(rows)})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(encode, f"key {kind}, ids binary")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)

    def add(held: list[np.ndarray]) -> np.ndarray:
        counts = np.bincount(np.concatenate(held))
        size = max(len(counts), len(total))
        return np.pad(total, (0, size - len(total))) + np.pad(counts, (0, size - len(counts)))

    for batch in batches:
        for some in _grouped(batch):
            total = add([ids for _, ids in some])
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})


def _grouped(batch: pa.RecordBatch) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Rows of a batch with their ids, about ``AT_ONCE`` ids at a time."""
    some, held = [], 0
    for row, raw in enumerate(batch.column("ids")):
        some.append((row, from_planes(raw.as_py())))
        held += len(some[-1][1])
        if held >= AT_ONCE:
            yield some
            some, held = [], 0
    if some:
        yield some


def id_counts(ids: DataFrame) -> DataFrame:
    """How often every id occurs; at most one row per entry of the vocabulary."""
    return ids.select("ids").mapInArrow(_counted, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths no longer than ``limit``, by package-merge."""
    size = len(counts)
    if size <= 1:
        return np.ones(size, np.int64)
    limit = max(limit, int(size - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    level, levels = leaves, [np.ones(size, bool)]
    for _ in range(limit - 1):
        even = level[: len(level) // 2 * 2]
        packages = even[0::2] + even[1::2]
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        levels.append(rank < size)
    lengths, taken = np.zeros(size, np.int64), 2 * size - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        lengths[:own] += 1
        taken = 2 * (taken - own)
    out = np.empty(size, np.int64)
    out[order] = lengths
    return out


class Codebook(NamedTuple):
    """Canonical codes: by id for writing, by the next ``limit`` bits for reading."""

    limit: int
    code: np.ndarray
    width: np.ndarray
    symbol: np.ndarray
    advance: np.ndarray


def codebook(ids: np.ndarray, lengths: np.ndarray) -> Codebook:
    limit = int(lengths.max()) if len(lengths) else 1
    order = np.lexsort((ids, lengths))
    ids, lengths = ids[order], lengths[order]
    # A canonical code is the left edge of its share of the code space, in steps of 2**-limit.
    shares = np.left_shift(1, limit - lengths)
    edges = np.concatenate([[0], np.cumsum(shares)])
    top = int(ids.max()) + 1 if len(ids) else 1
    code, width = np.zeros(top, np.uint64), np.zeros(top, np.uint8)
    code[ids] = edges[:-1] >> (limit - lengths)
    width[ids] = lengths
    symbol, advance = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    symbol[: edges[-1]] = np.repeat(ids, shares)
    advance[: edges[-1]] = np.repeat(lengths, shares)
    return Codebook(limit, code, width, symbol, advance)


def encode_documents(documents: list[np.ndarray], book: Codebook) -> tuple[list[bytes], list[bytes]]:
    """For every document the bits of each ``CHECKPOINT`` ids (unsigned 16-bit) and the codes, whole bytes."""
    ids = np.concatenate(documents)
    size = np.array([len(d) for d in documents])
    first = np.concatenate([[0], np.cumsum(size)])
    width = book.width[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(width)])
    octets = (ends[first[1:]] - ends[first[:-1]] + 7) // 8
    place = np.concatenate([[0], np.cumsum(octets)])
    begins = ends[:-1] + np.repeat(8 * place[:-1] - ends[first[:-1]], size)
    out = np.zeros(int(place[-1]) // 4 + 2, np.uint32)
    word = begins >> 5
    # A code lies in two neighbouring 32-bit words at most; codes of one word meet in one reduction.
    spread = book.code[ids] << (64 - (begins & 31) - width).astype(np.uint64)
    firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
    out[word[firsts]] |= np.bitwise_or.reduceat((spread >> np.uint64(32)).astype(np.uint32), firsts)
    out[word[firsts] + 1] |= np.bitwise_or.reduceat(spread.astype(np.uint32), firsts)
    raw = out.astype(">u4").tobytes()
    bits, codes = [], []
    for i in range(len(documents)):
        edges = np.append(ends[first[i] : first[i + 1] : CHECKPOINT], ends[first[i + 1]])
        bits.append(np.diff(edges).astype("<u2").tobytes())
        codes.append(raw[place[i] : place[i + 1]])
    return bits, codes


def pack_block(sizes: list[int], bits: list[bytes], codes: list[bytes]) -> bytes:
    """A block of encoded documents (see ``encode_documents``) of the given numbers of ids."""
    steps = np.frombuffer(b"".join(bits), "<u2").astype(np.int64)
    lanes = np.array([len(b) // 2 for b in bits])
    place = 8 * np.concatenate([[0], np.cumsum([len(c) for c in codes])[:-1]])
    ends = np.cumsum(steps)
    lane = np.concatenate([[0], np.cumsum(lanes)[:-1]])
    marks = ends - steps + np.repeat(place - (ends - steps)[lane], lanes)
    head = struct.pack("<II", len(sizes), len(marks))
    return head + np.array(sizes, "<u4").tobytes() + marks.astype("<u4").tobytes() + b"".join(codes)


def decode_block(block: bytes, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block, and the number of ids of each of its documents."""
    documents, marked = struct.unpack_from("<II", block)
    sizes = np.frombuffer(block, "<u4", documents, 8).astype(np.int64)
    at = np.frombuffer(block, "<u4", marked, 8 + 4 * documents).astype(np.int64)
    skip = 8 + 4 * (documents + marked)
    body = np.zeros(len(block) - skip + 8, np.uint8)
    body[:-8] = np.frombuffer(block, np.uint8, -1, skip)
    wide = body.astype(np.uint32)
    window = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    out = np.zeros((CHECKPOINT, marked), np.uint32)
    keep, shift = np.uint32((1 << book.limit) - 1), 32 - book.limit
    for step in range(CHECKPOINT):
        place = np.minimum(at >> 3, len(window) - 1)
        bits = (window[place] >> (shift - (at & 7)).astype(np.uint32)) & keep
        out[step] = book.symbol[bits]
        at = at + book.advance[bits]
    lanes = -(-sizes // CHECKPOINT)
    held = np.full(marked, CHECKPOINT)
    last = np.cumsum(lanes) - 1
    held[last] = sizes - CHECKPOINT * (lanes - 1)
    return out.T[np.arange(CHECKPOINT) < held[:, None]], sizes


def _coded(book: Codebook):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _grouped(batch):
                rows = pa.array([row for row, _ in some], pa.int64())
                bits, codes = encode_documents([ids for _, ids in some], book)
                yield pa.RecordBatch.from_pydict({
                    "part": batch.column("part").take(rows), "key": batch.column("key").take(rows),
                    "size": pa.array([len(ids) for _, ids in some], pa.int64()), "bits": binary_column(bits), "codes": binary_column(codes),
                })

    return encode


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by part and key."""
    part, number, first, held = None, 0, 0, []

    def close() -> pa.RecordBatch:
        sizes = [size for _, size, _, _ in held]
        block = pack_block(sizes, [bits for _, _, bits, _ in held], [codes for _, _, _, codes in held])
        keys = [str(key) if key is not None else None for key, _, _, _ in held]
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "first": pa.array([first], pa.int64()),
            "n_ids": pa.array([sum(sizes)], pa.int64()), "keys": pa.array([keys], pa.list_(pa.string())), "block": binary_column([block]),
        })

    ids = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "key", "size", "bits", "codes")]
        for own, *row in zip(*columns, strict=True):
            if held and (own != part or ids >= BLOCK_IDS):
                yield close()
                number, first = (number + 1, first + ids) if own == part else (0, 0)
                ids, held = 0, []
            elif own != part:
                number, first = 0, 0
            part = own
            held.append(row)
            ids += row[1]
    if held:
        yield close()


def write_store(ids: DataFrame, folder: str) -> None:
    """Write ``key``, ``ids`` rows (see ``token_ids``; a written table) to ``folder``."""
    spark = ids.sparkSession
    counts = sorted((r.id, r.n) for r in id_counts(ids).collect())
    symbols = np.array([i for i, _ in counts], np.int64)
    lengths = code_lengths(np.array([n for _, n in counts], np.int64))
    table = [(int(i), int(n)) for i, n in zip(symbols, lengths, strict=True)]
    spark.createDataFrame(table, "id bigint, width int").coalesce(1).write.parquet(f"{folder}/codebook")
    dealt = bucket_by_order(ids, "key", name="part").select("part", "key", "ids")
    kind = ids.schema["key"].dataType.simpleString()
    coded = dealt.mapInArrow(_coded(codebook(symbols, lengths)), f"part int, key {kind}, size bigint, bits binary, codes binary")
    ordered = coded.withColumn("tie", F.xxhash64("codes")).repartition("part").sortWithinPartitions("part", "key", "tie").drop("tie")
    schema = "part int, number int, first bigint, n_ids bigint, keys array<string>, block binary"
    ordered.mapInArrow(_blocks, schema).write.parquet(f"{folder}/blocks")


def _documents(book: Codebook):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = decode_block(row["block"], book)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                ids = ids.astype("<u4")
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * len(ends), pa.int32()), "key": pa.array(row["keys"], pa.string()),
                    "at": pa.array(begins + row["first"], pa.int64()),
                    "ids": binary_column([ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]),
                })

    return read


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a store: ``key`` (as text), ``start`` (ids of all documents before it) and ``ids``."""
    table = spark.read.parquet(f"{folder}/codebook").collect()
    book = codebook(np.array([r.id for r in table], np.int64), np.array([r.width for r in table], np.int64))
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per part; their number is fixed when they are dealt.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    rows = blocks.select("part", "first", "keys", "block").mapInArrow(_documents(book), "part int, key string, at bigint, ids binary")
    return rows.join(F.broadcast(bases), F.col("part") == F.col("p")).select("key", (F.col("at") + F.col("base")).alias("start"), "ids")


def round_trip(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Write the token ids of ``docs`` to a store and report what is read back from it."""
    if not isinstance(docs.schema[key].dataType, T.NumericType):
        raise TypeError(f"{key} orders the file and must be a number, it is {docs.schema[key].dataType.simpleString()}")
    folder = folder or scratch(docs.sparkSession, "store")
    ids = scratch(docs.sparkSession, "ids")
    token_ids(docs, key, text, path, end_id).write.option("compression", "zstd").parquet(ids)
    write_store(docs.sparkSession.read.parquet(ids), folder)
    found = read_store(docs.sparkSession, folder)
    kind = docs.schema[key].dataType
    return found.select(
        F.col("key").cast(kind).alias(key), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
