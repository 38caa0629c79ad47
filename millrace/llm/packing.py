"""Packing of token pieces into sequences of a fixed capacity by exact-complement hashing.

Only the histogram of piece lengths decides the plan, and it has at most ``capacity`` entries. Sums
of one, two and three lengths are looked up under the counts still available: for every length,
longest first, combinations that fill the rest of the sequence exactly are consumed, each as often
as the scarcest member allows. What is left goes to the tightest open gap (best fit, longest first).
Every step uses up a length or a class of sequences, so the plan is short however many pieces there
are. Pieces then find their place by their rank among the pieces of equal length; ranks are dealt
over salted groups, so a length that a third of all pieces have is no bottleneck.

Defined results: a null text is empty and packs as its end id alone; a text of up to ``capacity`` ids
is one piece; of a longer one the first piece is the remainder and all others are full; repeated rows
are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import ROOMY, Memory, encoded
from millrace.session import cut_lineage

CAPACITY = 2048
#: Pieces of one length that are ranked in one group, about, and the least number of groups.
RANKED_TOGETHER, GROUPS = 200_000, 16


def piece_lengths(total: int, capacity: int) -> list[int]:
    rest = total % capacity
    return [rest] * (rest > 0) + [capacity] * (total // capacity)


def token_pieces(
    docs: DataFrame, key: str, text: str, path: str, end_id: int, capacity: int = CAPACITY, keep_ids: bool = False, memory: Memory = ROOMY
) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``
    (little-endian unsigned 32-bit)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = "key " + kind + ", piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, ends in encoded(batches, path, blank_matters=True, memory=memory):
            rows, pieces, starts, widths, sums, kept = [], [], [], [], [], []
            for row in range(part.num_rows):
                own = np.append(ids[ends[row] : ends[row + 1]], end_id).astype("<u4")
                start = 0
                for number, width in enumerate(piece_lengths(len(own), capacity)):
                    raw = own[start : start + width].tobytes()
                    rows.append(row)
                    pieces.append(number)
                    starts.append(start)
                    widths.append(width)
                    sums.append(zlib.crc32(raw))
                    if keep_ids:
                        kept.append(raw)
                    start += width
            columns = {
                "key": part.column("key").take(pa.array(rows, pa.int64())), "piece": pa.array(pieces, pa.int32()),
                "start": pa.array(starts, pa.int64()), "length": pa.array(widths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(cut, schema)


class Plan:
    """Which lengths share a sequence: classes of equal sequences, found from the histogram alone."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = [0] * (capacity + 1)
        for length, count in histogram.items():
            self.left[length] = count
        self.classes: list[tuple[int, tuple[int, ...]]] = []
        #: For every sum, the larger part of the next pair to try; parts only ever run out.
        self.pair_from = list(range(-1, capacity))
        for length in range(capacity, 0, -1):
            if self.left[length]:
                self._fill_exactly(length)
        self._best_fit()

    def _consume(self, lengths: tuple[int, ...]) -> bool:
        times = min(self.left[x] // lengths.count(x) for x in set(lengths))
        if times:
            for x in lengths:
                self.left[x] -= times
            self.classes.append((times, lengths))
        return times > 0

    def _pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths with the given sum, the most unequal ones first."""
        big = self.pair_from[total]
        while big >= total - big:
            small = total - big
            if self.left[big] > (big == small) and self.left[small]:
                self.pair_from[total] = big
                return big, small
            big -= 1
        self.pair_from[total] = big
        return None

    def _fill_exactly(self, length: int) -> None:
        gap = self.capacity - length
        if gap == 0:
            self._consume((length,))
            return
        if self.left[gap]:
            self._consume((length, gap))
        while self.left[length] and (pair := self._pair(gap)):
            if not self._consume((length, *pair)):
                break
        for big in range(gap - 2, 0, -1):
            while self.left[length] and self.left[big] and (pair := self._pair(gap - big)):
                if not self._consume((length, big, *pair)):
                    break
            if not self.left[length]:
                break

    def _best_fit(self) -> None:
        open_by_gap: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        for length in range(self.capacity, 0, -1):
            count, self.left[length] = self.left[length], 0
            gap = length
            while count and gap <= self.capacity:
                waiting = open_by_gap.get(gap)
                if not waiting:
                    gap += 1
                    continue
                times, lengths = waiting.pop()
                used = min(times, count)
                if times > used:
                    waiting.append((times - used, lengths))
                open_by_gap.setdefault(gap - length, []).append((used, (*lengths, length)))
                count -= used
            each = self.capacity // length
            for times, size in ((count // each, each), (1, count % each)):
                if times and size:
                    open_by_gap.setdefault(self.capacity - size * length, []).append((times, (length,) * size))
        self.classes += [x for waiting in open_by_gap.values() for x in waiting]

    def places(self) -> tuple[np.ndarray, ...]:
        """Per slot of a class: length, first rank, first sequence and offset, sorted by length and rank."""
        used, rows, sequence = [0] * (self.capacity + 1), [], 0
        for times, lengths in self.classes:
            offset = 0
            for x in lengths:
                rows.append((x, used[x], sequence, offset))
                used[x] += times
                offset += x
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return tuple(np.ascontiguousarray(table[:, i]) for i in range(4))


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """Add ``rank`` from 0 among the pieces of equal length; no group is larger than its salted share."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("length").alias("l"), F.col("salt").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("key", "piece", "ids_crc32")
    numbered = salted.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(bases, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s"))).select(
        *pieces.columns, (F.col("at") + F.col("base")).alias("rank")
    )


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (see ``token_pieces``)."""
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(histogram.values())
    lengths, ranks, sequences, offsets = Plan(histogram, capacity).places()
    # Length and rank in one sorted number: ranks of a length are below the number of pieces.
    step = max(1, total)
    slots = lengths * step + ranks

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(slots, batch.column("length").to_numpy(zero_copy_only=False) * step + rank, "right") - 1
            own = {name: batch.column(name) for name in batch.schema.names if name != "rank"}
            own["sequence_id"] = pa.array(sequences[at] + rank - ranks[at], pa.int64())
            own["offset"] = pa.array(offsets[at], pa.int64())
            yield pa.RecordBatch.from_pydict(own)

    with_rank = ranked(pieces, max(GROUPS, total // RANKED_TOGETHER))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return with_rank.mapInArrow(put, f"{kinds}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False, memory: Memory = ROOMY
) -> DataFrame:
    """Tokenize ``docs`` with the vocabulary at ``path``, end each text with ``end_id`` and pack all
    pieces. ``memory`` is the tokenizer's: the result is the same with any."""
    pieces = cut_lineage(token_pieces(docs, key, text, path, end_id, capacity, keep_ids, memory), "pieces")
    placed = place(pieces, capacity)
    return placed.withColumnRenamed("key", key)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences as ids, from pieces placed with ``keep_ids``; none is longer than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
