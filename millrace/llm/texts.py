"""Word splitting and hashing over whole Arrow text columns, shared by the operators here.

A text is cut into words at byte level: every separator is an ASCII byte, so UTF-8 never gets in
the way. All words of a slice of texts are hashed at once with prefix sums; nothing loops over
words. Slices hold a few megabytes of text, so memory does not depend on the batch size; one text
is never cut, so a slice is at least one whole text.

Nulls count as empty texts. 64-bit hashes stand for words: two given different words agree with
probability 2**-64.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
HASH_BYTES = 1 << 16

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A 256-entry table that is true inside the given closed byte ranges."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: Words are runs of anything but blank and the ASCII white space 0x09-0x0D.
PLAIN = ~byte_class((0x09, 0x0D), (0x20, 0x20))
#: Words are runs of ASCII letters and digits and of everything outside ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


LOWER = lower_table()


def worker_memory(name: str) -> dict:
    """A dictionary that outlives the task: Python workers are reused, functions travel by value."""
    holder = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    return holder.__dict__.setdefault(name, {})


def release() -> None:
    """Give back what operators that are over have left in this worker's memory."""
    for name in ("encoders", "automaton"):
        worker_memory(name).clear()
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    kept = worker_memory("powers")
    if len(kept.get("up", ())) < count:
        size = 1 << max(16, int(count - 1).bit_length())
        for name, step in (("up", _STEP), ("down", _STEP_INVERSE)):
            factors = np.full(size, step, np.uint64)
            factors[0] = 1
            kept[name] = np.multiply.accumulate(factors)
    return kept["up"], kept["down"]


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of every run ``values[start:end]``; equal runs agree wherever they stand."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


BYTE_VALUES = _byte_values()


class Words(NamedTuple):
    """Words of a slice of texts: byte places, and ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A hash of every word, worked out in blocks that fit a processor's cache."""
        out = np.empty(len(self.start), np.uint64)
        cuts = np.searchsorted(self.start, np.arange(0, len(self.data) + HASH_BYTES, HASH_BYTES))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low < high:
                base = self.start[low]
                values = BYTE_VALUES[self.data[base : self.end[high - 1]]]
                out[low:high] = run_hashes(values, self.start[low:high] - base, self.end[low:high] - base)
        return out

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool) -> Words:
    if lower:
        data = LOWER[data]
    flag = np.zeros(len(data) + 2, bool)
    flag[1:-1] = inside[data]
    begins = flag[1:-1] & ~flag[:-2]
    ends = flag[1:-1] & ~flag[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = flag[1:-1][cuts]
    ends[cuts - 1] = flag[1:-1][cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of whole rows holding about ``size`` bytes of text, with their bytes and offsets."""
    data, offsets = buffers(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield batch.slice(row, stop - row), data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def packed(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers as ``width`` byte planes, least first, compressed with zstd."""
    planes = np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :width].T
    raw = np.ascontiguousarray(planes).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpacked(blob: bytes, count: int, width: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.uint64)
    raw = pa.decompress(blob, decompressed_size=count * width, codec="zstd", asbytes=True)
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, count).T
    return out.view(np.uint64).ravel()
