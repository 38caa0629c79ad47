"""Benchmark decontamination with Aho-Corasick automata.

Items of a benchmark are normalised to words and cut into windows; the automaton holds every
window, and every text is normalised the same way and scanned once. A word of a text is hit when it
lies inside an occurrence of a window. Hits are kept as word intervals and as character spans of the
original text.

The windows are dealt by hash into blocks of at most about ``BLOCK_BYTES``, and the texts pass over
one automaton after the other; an ordinary benchmark is one block. Only one block at a time is sent
to the executors, so what is sent has a bound whatever the benchmark's size.

Defined results: a null text or item has no words and hits nothing; an item shorter than a window is
one window; items with equal windows are all reported; a null item id is reported as ``''``;
repeated rows are judged one by one; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.names import named, packed_row, unpacked_row
from millrace.llm.texts import ALNUM, LOWER, buffers, find_words, slices, worker_memory
from millrace.session import cut_lineage

WINDOW = 10
BLOCK_BYTES = 8 << 20

_INTERVALS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out_ids, out = batch.column("item").to_pylist(), [], []
        data, offsets = buffers(batch.column("text"))
        found = find_words(data, offsets, ALNUM, lower=True)
        for row, item in enumerate(ids):
            low, high = int(found.first[row]), int(found.first[row + 1])
            words = [found.data[found.start[i] : found.end[i]].tobytes() for i in range(low, high)]
            windows = {b" ".join(words[i : i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))} if words else set()
            out_ids += [item or ""] * len(windows)
            out += sorted(windows)
        yield pa.RecordBatch.from_pydict({"item": pa.array(out_ids, pa.string()), "window": pa.array(out, pa.binary())})


def windows_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, window): the windows of every item, normalised."""
    items = benchmark.select(named(item).cast("string").alias("item"), named(text).alias("text"))
    return items.mapInArrow(_item_windows, "item string, window binary").distinct()


class Automaton:
    """The windows of one block, built once per Python worker."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        self.owners: list[list[str]] = []
        self.widths: list[int] = []
        self.tree = ahocorasick.Automaton()
        places: dict[bytes, int] = {}
        for window, item in rows:
            place = places.setdefault(window, len(self.owners))
            if place == len(self.owners):
                self.owners.append([])
                self.widths.append(window.count(b" ") + 1)
                # Bytes stand as one character each, so places in the scanned string are bytes.
                self.tree.add_word(f" {window.decode('latin-1')} ", place)
            self.owners[place].append(item)
        if rows:
            self.tree.make_automaton()

    def occurrences(self, text: str) -> Iterator[tuple[int, int]]:
        return self.tree.iter(text) if self.owners else iter(())


def _merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def _scanner(rows: list[tuple[bytes, str]]):
    name = hashlib.sha256(repr(rows).encode()).hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_memory("automaton")
        if kept.get("name") != name:
            kept.clear()
            kept |= {"name": name, "automaton": Automaton(rows)}
        automaton = kept["automaton"]
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                yield _scan_slice(automaton, part, data, offsets)

    return scan


def _scan_slice(automaton: Automaton, part: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    found = find_words(raw, offsets, ALNUM, lower=True)
    inside = ALNUM[raw]
    after = np.zeros(len(raw), bool)
    after[1:] = inside[:-1]
    after[offsets[:-1][offsets[:-1] < len(raw)]] = False
    keep = inside | after
    plain = np.where(inside, LOWER[raw], np.uint8(0x20))
    counts, intervals, spans, items = np.diff(found.first), [], [], []
    earlier, known = part.column("intervals").to_pylist(), part.column("items").to_pylist()
    for row in range(part.num_rows):
        low, high = offsets[row], offsets[row + 1]
        body = " " + plain[low:high][keep[low:high]].tobytes().decode("latin-1") + " "
        hits = list(automaton.occurrences(body))
        old = [(x["from"], x["to"]) for x in earlier[row]]
        owners = set(known[row])
        first = int(found.first[row])
        start, end = found.start[first : first + counts[row]], found.end[first : first + counts[row]]
        if hits:
            begins = 1 + np.concatenate([[0], np.cumsum(end - start + 1)[:-1]])
            last = np.searchsorted(begins, [place for place, _ in hits])
            for stop, (_, window) in zip(last.tolist(), hits, strict=True):
                old.append((stop - automaton.widths[window], stop))
                owners.update(automaton.owners[window])
        merged = _merged(old)
        intervals.append([{"from": a, "to": b} for a, b in merged])
        items.append(sorted(owners))
        if merged:
            characters = np.concatenate([[0], np.cumsum((raw[low:high] & 0xC0) != 0x80)])
            spans.append([{"from": int(characters[start[a] - low]), "to": int(characters[end[b - 1] - low])} for a, b in merged])
        else:
            spans.append([])
    columns = {
        "row": part.column("row"), "text": part.column("text"), "n_words": pa.array(counts, pa.int64()),
        "intervals": pa.array(intervals, _INTERVALS), "spans": pa.array(spans, _INTERVALS), "items": pa.array(items, pa.list_(pa.string())),
    }
    return pa.RecordBatch.from_pydict(columns)


def scan(docs: DataFrame, windows: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct without the text) and ``text``, with ``n_words``,
    the hit word ``intervals``, the hit character ``spans`` and the ``items`` that occur."""
    total = windows.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    if blocks > 1:
        dealt = cut_lineage(dealt, "windows")
    nothing = "array<struct<from: bigint, to: bigint>>"
    state = docs.select(
        packed_row(docs, text).alias("row"), named(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast(nothing).alias("intervals"), F.array().cast(nothing).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    for block in range(blocks):
        rows = sorted((bytes(r.window), r.item) for r in dealt.filter(F.col("block") == block).select("window", "item").collect())
        state = state.mapInArrow(_scanner(rows), state.schema)
        if block + 1 < blocks:
            state = cut_lineage(state, "scanned")
    return state


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: words, hit words, the number and the digest of the items that occur."""
    found = scan(docs.select(named(key), named(text)), windows_of(benchmark, item, item_text), text)
    n_hit = F.aggregate("intervals", F.lit(0).cast("long"), lambda acc, x: acc + x["to"] - x["from"])
    return found.select(
        F.col("row").getField(key).alias(key), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("intervals") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns as they were, that no benchmark window occurs in."""
    found = scan(docs, windows_of(benchmark, item, item_text), text).filter(F.size("intervals") == 0)
    return found.select(*unpacked_row(docs, **{text: F.col("text")}))
