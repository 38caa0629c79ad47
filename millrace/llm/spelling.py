"""Spelling variants: words one edit apart, found over a reduced alphabet.

Runs of ASCII letters and of U+00C0 to U+00FF are taken from every whole text and only A-Z
lower-cased. Let h be the unsigned crc32 of ``<id>:<run>`` in UTF-8; where ``SLIP`` divides h the
code point at h % length is left out, which plants slips of the pen alike in every system. Words are
the distinct results of ``LETTERS`` code points and ``SEEN`` occurrences at least. Two words are near
if they differ by exactly one inserted, deleted or replaced code point.

Every letter is hashed to one of ``SYMBOLS`` symbols. Words one edit apart have reduced words at most
one edit apart, so each reduced word's whole one-edit neighbourhood is met with the reduced
vocabulary. A pair needs to be met once only: the longer one generates its deletions, and of two
equally long ones the one with the larger symbol at the replaced place its replacements, which is the
half of the neighbourhood that lies below a word; the half above it is met from the other word. Reduced
words travel as 64-bit polynomial hashes, worked out for all words of one length at once, in time and
memory that grow with a word's length, not its square. A bitmap of the reduced vocabulary, sized by
its count (``bitmaps``), stops neighbours that nobody has before the shuffle. Candidates are verified
inside the join on the original strings, so a chance agreement costs a comparison and nothing else.

A word's form is its near word of the largest count (ties: the smallest in code-point order) if that
has at least ``TIMES`` its count; the root follows forms to the last one by pointer doubling, whose
rounds grow with the logarithm of the chain, and a chain grows its counts ``TIMES``-fold a step.

Cost: per text one pass; words are counted per task before they are shuffled. A word has at most
(2 length + 1) * 90 near words, so no word is a hot key.

Defined cases: null, empty and letterless texts have no runs; a null id counts as an empty one in
``<id>:``. Rows with equal ids count each for itself. Empty tables give an empty result. Other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bitmaps import Bitmap, bitmap
from millrace.llm.texts import mix
from millrace.session import cut_lineage

#: Words that a task counts before it hands them on.
COUNTED = 1 << 18
#: Code points of words that are worked on at once.
TOGETHER = 1 << 16
FIRST_WIDE, LAST_WIDE = 0xC0, 0xFF

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Rule(NamedTuple):
    """What counts as a word, where slips are planted, and how much commoner a form is."""

    letters: int = 6
    seen: int = 5
    slip: int = 199
    times: int = 5
    symbols: int = 8


def _counted(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # A run that is too short for a word stays so without a letter.
    runs = re.compile(f"[a-z{chr(FIRST_WIDE)}-{chr(LAST_WIDE)}]{{{rule.letters},}}").findall

    def flushed(total: Counter) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
        total.clear()
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                before = zlib.crc32(f"{key.as_py() or ''}:".encode())
                for run, n in Counter(runs(text.as_py().encode().translate(_LOWER).decode())).items():
                    h = zlib.crc32(run.encode(), before)
                    if h % rule.slip == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < rule.letters:
                            continue
                    total[run] += n
                if len(total) >= COUNTED:
                    yield flushed(total)
        yield flushed(total)

    return work


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts."""
    rule = rule or Rule()
    source = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    counts = source.mapInArrow(_counted(rule), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= rule.seen)


def symbols(count: int) -> np.ndarray:
    """The symbol (from 1) of every code point up to ``LAST_WIDE``."""
    return (mix(np.arange(LAST_WIDE + 1, dtype=np.uint64) * _BASE) % np.uint64(count)).astype(np.uint64) + np.uint64(1)


def _spelled(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, with their code points as a matrix, a bounded number at once."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        some = max(1, TOGETHER // max(length, 1))
        for at in range(0, len(places), some):
            own = places[at : at + some]
            yield own, np.frombuffer("".join([words[k] for k in own.tolist()]).encode("utf-32-le"), np.uint32).reshape(len(own), length)


def _hashed(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length))


def reduced_hashes(words: list[str], table: np.ndarray) -> np.ndarray:
    """The hash of every reduced word."""
    out = np.empty(len(words), np.uint64)
    for places, spelled in _spelled(words):
        powers = np.multiply.accumulate(np.full(spelled.shape[1], _BASE, np.uint64))
        out[places] = _hashed((table[spelled] * powers).sum(axis=1, dtype=np.uint64), spelled.shape[1])
    return out


def lower_neighbours(words: list[str], table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words and hashes of reduced words below theirs: itself, without one symbol, with a
    smaller symbol at one place. Each is given once a word."""
    for places, spelled in _spelled(words):
        length = spelled.shape[1]
        codes = table[spelled]
        powers = np.multiply.accumulate(np.full(length, _BASE, np.uint64))
        values = codes * powers
        upto = np.cumsum(values, axis=1, dtype=np.uint64)
        whole = upto[:, -1:]
        yield places, _hashed(whole[:, 0], length)
        # Any symbol of a run of equal ones leaves the same behind.
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, at = np.nonzero(first)
        yield places[row], _hashed(upto[row, at] - values[row, at] + (whole[row, 0] - upto[row, at]) * _BASE_INVERSE, length - 1)
        for symbol in range(1, int(table.max())):
            row, at = np.nonzero(codes > symbol)
            yield places[row], _hashed(whole[row, 0] + (np.uint64(symbol) - codes[row, at]) * powers[at], length)


def _keyed(count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbols(count)
        for batch in batches:
            keys = reduced_hashes(batch.column("word").to_pylist(), table)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(keys.view(np.int64), pa.int64())], ["word", "n", "key"])

    return work


def _neighbours(count: int, there: Bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbols(count)
        for batch in batches:
            for places, hashes in lower_neighbours(batch.column("word").to_pylist(), table):
                kept = there.marked(hashes)
                own = batch.take(pa.array(places[kept]))
                yield pa.RecordBatch.from_arrays([own.column("word"), own.column("n"), pa.array(hashes[kept].view(np.int64), pa.int64())], ["above", "above_n", "key"])

    return work


def _reduced(word: Column, rule: Rule) -> Column:
    letters = [*range(0x61, 0x7B), *range(FIRST_WIDE, LAST_WIDE + 1)]
    table = symbols(rule.symbols)
    return F.translate(word, "".join(map(chr, letters)), "".join(chr(0x100 + int(table[x])) for x in letters))


def near_pairs(words: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``above``, ``above_n``, ``word`` and ``n``: every pair of near words of (word, n) once."""
    rule = rule or Rule()
    keyed = cut_lineage(words.mapInArrow(_keyed(rule.symbols), "word string, n bigint, key bigint"), "reduced")
    there = bitmap(keyed.select("key").distinct(), "key")
    found = keyed.select("word", "n").mapInArrow(_neighbours(rule.symbols, there), "above string, above_n bigint, key bigint")
    longer, equal = F.length("above") > F.length("word"), F.length("above") == F.length("word")
    higher = F.struct(_reduced(F.col("above"), rule), F.col("above")) > F.struct(_reduced(F.col("word"), rule), F.col("word"))
    # The order makes sure that two hashes that agree by chance give no pair twice.
    near = (longer | (equal & higher)) & (F.levenshtein("above", "word", 1) == 1)
    return found.join(keyed, (found.key == keyed.key) & near).select("above", "above_n", "word", "n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for every row of (word, form): forms followed to the last."""
    known = cut_lineage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(known.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        known = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return known


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """Per word: its count, the number of near words, its form with that one's count, and its root."""
    rule = rule or Rule()
    words = cut_lineage(vocabulary(docs, key, text, rule), "words")
    pairs = cut_lineage(near_pairs(words, rule), "near")
    either = pairs.select(F.col("above").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")).unionByName(
        pairs.select("word", F.col("above").alias("near"), F.col("above_n").alias("near_n"))
    )
    best = either.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    commoner = -F.col("best.minus") >= rule.times * F.col("n")
    formed = cut_lineage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(commoner, F.col("best.near")).alias("form"), F.when(commoner, -F.col("best.minus")).alias("form_n"),
    ), "formed")
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
