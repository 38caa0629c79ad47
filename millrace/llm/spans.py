"""Long repeated word spans, found on a de Bruijn graph that is compacted before it is counted.

An edge of the graph is a window of ``WINDOW`` words; consecutive windows of a text follow each
other through the words they share. Every window has a minimizer, its smallest hashed run of
``SEED`` words (the first of equals), and equal windows have equal minimizers. Consecutive windows
with the same minimizer occurrence form a path: it does not branch inside one text, and it is
represented by one row, (minimizer, hash of the path's words), instead of one row a window.

Paths are counted and meet by minimizer through Spark joins:

* a path that occurs twice is repeated as a whole, all its windows are;
* where one minimizer has several different paths the graph branches, and only there the paths of
  one occurrence are opened into windows, counted, and joined back;
* anything else occurs once.

The repeated pieces go back to their source coordinates, where neighbours join to long spans, and
the words of the text itself are cut there.

Hot paths cost no more than others: counts combine before they move, and the joins that carry one
row an occurrence have a single row of the path on the other side, which Spark may split and copy.
Minimizers that cannot repeat are recognised in the second scan by a bitmap sized by the count of
those that do (see ``bitmaps``); a false positive only moves a row that the join then drops.

Words stand as 64-bit hashes; two different paths are taken for one only if both the minimizer's and
the path's hashes agree.

Defined results: a null text has no words; a text shorter than a window keeps every word; words of
repeated rows are removed like those of any two texts; nothing is removed from a table of one text
without repetition; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bitmaps import Bitmap, bitmap
from millrace.llm.names import named, packed_row, unpacked_row
from millrace.llm.texts import PLAIN, find_words, release, run_hashes, slices
from millrace.session import cut_lineage

WINDOW = 35
SEED = 12


class Paths:
    """The paths of a slice of texts: first window, last window, minimizer, hash, and text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, seed: int = SEED):
        self.words = find_words(data, offsets, PLAIN, lower=False)
        self.hashes = self.words.hashes()
        self.window = window
        size = len(self.hashes)
        if size < window:
            self.first = self.last = self.text = np.zeros(0, np.int64)
            self.minimizer = self.path = np.zeros(0, np.uint64)
            return
        starts = np.arange(size - seed + 1)
        seeds = run_hashes(self.hashes, starts, starts + seed)
        least = _first_least(seeds, window - seed + 1)
        text = self.words.text_of()
        whole = text[: size - window + 1] == text[window - 1 :]
        same = np.zeros(len(least) + 1, bool)
        same[1:-1] = whole[1:] & whole[:-1] & (least[1:] == least[:-1])
        self.first = np.flatnonzero(whole & ~same[:-1])
        self.last = np.flatnonzero(whole & ~same[1:])
        self.text = text[self.first]
        self.minimizer = seeds[least[self.first]]
        self.path = run_hashes(self.hashes, self.first, self.last + window)

    def windows(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of the given paths, and the offsets of each path's."""
        count = last - first + 1
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(first - ends[:-1], count) + np.arange(ends[-1])
        return run_hashes(self.hashes, at, at + self.window), ends


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values the place of its least one, the first of equals."""
    place, covered = np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = place[:-step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        covered += step
    return place


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _list_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for _, data, offsets in slices(batch, "text"):
            found = Paths(data, offsets)
            yield pa.RecordBatch.from_pydict({"minimizer": _signed(found.minimizer), "path": _signed(found.path)})


def _place_paths(repeated: Bitmap, branching: Bitmap):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                found = Paths(data, offsets)
                keep = np.flatnonzero(repeated.marked(found.minimizer))
                first, last, minimizer = found.first[keep], found.last[keep], found.minimizer[keep]
                opened = branching.marked(minimizer)
                hashes, ends = found.windows(first[opened], last[opened])
                begin = np.zeros(len(keep) + 1, np.int64)
                begin[1:] = np.cumsum(np.where(opened, last - first + 1, 0))
                at = first - found.words.first[found.text[keep]]
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("key").take(pa.array(found.text[keep], pa.int64())), "minimizer": _signed(minimizer),
                    "path": _signed(found.path[keep]), "at": pa.array(at, pa.int64()), "windows": pa.array(last - first + 1, pa.int64()),
                    "hashes": pa.LargeListArray.from_arrays(pa.array(begin, pa.int64()), _signed(hashes)).cast(pa.list_(pa.int64())),
                })

    return scan


def _digest(key: str, text: str) -> Column:
    return F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(named(key).cast("string"), F.lit("")), F.coalesce(named(text), F.lit("")))))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``: a digest of the row's id and text. Rows that share it are the same text."""
    return docs.select(_digest(key, text).alias("key"), named(text).alias("text"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` (see ``_keyed``) and ``spans``: the word intervals covered by windows that occur again."""
    keyed = _keyed(docs, key, text)
    paths = keyed.select("text").mapInArrow(_list_paths, "minimizer bigint, path bigint")
    counted = paths.groupBy("minimizer", "path").agg(F.count(F.lit(1)).alias("times"))
    # A minimizer may have a path in every text: its paths are counted by an aggregate and joined back.
    kinds = counted.groupBy("minimizer").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("total")).filter(F.col("total") > 1)
    met = cut_lineage(counted.join(kinds.drop("total"), "minimizer"), "paths")
    known = met.select("minimizer", (F.col("kinds") > 1).alias("branches")).distinct()
    repeated, branching = bitmap(known, "minimizer"), bitmap(known.filter("branches"), "minimizer")
    schema = "key binary, minimizer bigint, path bigint, at bigint, windows bigint, hashes array<bigint>"
    placed = keyed.mapInArrow(_place_paths(repeated, branching), schema)
    placed = cut_lineage(placed.join(met, ["minimizer", "path"]), "placed")

    whole = placed.filter(F.col("times") > 1).select("key", F.col("at").alias("from"), (F.col("at") + F.col("windows") + WINDOW - 1).alias("to"))
    single = placed.filter((F.col("times") == 1) & (F.col("kinds") > 1))
    # One occurrence of every path that meets another one: enough to count what they share.
    witnesses = placed.filter(F.col("kinds") > 1).groupBy("minimizer", "path").agg(F.first("hashes").alias("hashes"))
    shared = witnesses.select("minimizer", F.explode("hashes").alias("hash")).groupBy("minimizer", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    opened = single.select("key", "at", "minimizer", F.posexplode("hashes").alias("step", "hash"))
    parts = opened.join(shared.drop("n"), ["minimizer", "hash"]).select(
        "key", (F.col("at") + F.col("step")).alias("from"), (F.col("at") + F.col("step") + WINDOW).alias("to")
    )
    both = whole.unionByName(parts)
    return both.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("from", "to"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            words = find_words(data, offsets, PLAIN, lower=False)
            spans, removed, kept = part.column("spans"), [], []
            for row in range(part.num_rows):
                low, high = int(words.first[row]), int(words.first[row + 1])
                edge = np.zeros(high - low + 1, np.int64)
                if spans[row].is_valid:
                    own = spans[row].values.flatten()
                    np.add.at(edge, own[0].to_numpy(), 1)
                    np.add.at(edge, own[1].to_numpy(), -1)
                stay = np.cumsum(edge[:-1]) == 0
                removed.append(high - low - int(stay.sum()))
                start, end = words.start[low:high][stay], words.end[low:high][stay]
                kept.append(_joined(words.data, start, end))
            yield pa.RecordBatch.from_pydict({
                "row": part.column("row"), "text": part.column("text"), "n_words": pa.array(np.diff(words.first), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            })


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words of data, one blank between them."""
    if not len(start):
        return b""
    width = end - start + 1
    ends = np.cumsum(width)
    out = data[np.minimum(np.repeat(start - ends + width, width) + np.arange(ends[-1]), len(data) - 1)]
    out[ends - 1] = 0x20
    return out[:-1].tobytes()


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct without the text) and ``text``, with ``n_words``,
    ``n_removed``, the text of the ``kept`` words joined by one blank, and its ``kept_sha256``."""
    rows = docs.select(_digest(key, text).alias("key"), packed_row(docs, text).alias("row"), named(text).alias("text"))
    joined = rows.join(repeated_spans(docs, key, text), "key", "left").select("row", "text", "spans")
    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    texts = [T.StructField(c, T.StringType()) for c in ("kept", "kept_sha256")]
    return joined.mapInArrow(_cut, T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), *counts, *texts]))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, removed words and the digest of what is kept."""
    cut = cut_repeats(docs.select(named(key), named(text)), key, text)
    return cut.select(F.col("row").getField(key).alias(key), "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with its columns, where texts that have repeated words are their kept words joined by
    one blank; a column named ``length`` follows. Other texts stay as they are, and no row goes."""
    cut = cut_repeats(docs, key, text)
    changed = F.col("n_removed") > 0
    own = {text: F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if length in docs.columns and length != text:
        own[length] = F.when(changed, F.length("kept").cast(docs.schema[length].dataType)).otherwise(F.col("row").getField(length))
    return cut.select(*unpacked_row(docs, **own))
