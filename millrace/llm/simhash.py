"""Near duplicates by SimHash: 64-bit fingerprints, linked where few bits differ.

A text's A-Z are lower-cased, its words are runs of anything but ASCII white space, and every
shingle of ``words`` consecutive words (joined by one space, repeats included; fewer words: all of
them as one) is hashed with XXH64, seed 42. A fingerprint's bit is 1 if more than half of the
hashes have it. Two fingerprints link at ``radius`` or fewer differing bits.

The comparison is exact and goes by tiles. Distinct fingerprints are ordered by their population
count, then by the population counts of their four 16-bit quarters, and cut into tiles of ``TILE``.
A tile knows the least and largest of these counts; as a differing bit moves one quarter's count by
one, the gaps of two tiles' counts bound the distance of any pair from below, and pairs of tiles
whose counts differ beyond the radius are never compared. The others are one row each, and a task
compares them with exclusive-or and bit counts, skipping runs of ``LEAF`` fingerprints by the same
bound. Of the links it finds, a task returns a spanning forest, so a group of n near copies costs
at most n - 1 rows a tile pair, never n squared.

Cost: comparisons grow with the square of the *distinct* fingerprints (times the share of tile
pairs that pass), as an exact tiled comparison does; each tile travels once per tile it is compared
with. Exact copies cost one fingerprint.

Defined cases: null, empty and blank texts have fingerprint zero, which links like any other. Rows
with equal ids are rows of their own. A null id is an id of no order: a component whose ids are all
null has a null ``component_id``. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.texts import LOWER, PLAIN, find_words, slices
from millrace.session import cut_lineage, shuffle_width

WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a tile: half a megabyte.
TILE = 1 << 16
#: Fingerprints of a run that is skipped or compared as a whole.
LEAF = 64
#: Comparisons of one numpy step.
STEP = 1 << 17
#: Tile pairs of a task, on average.
PAIRS_OF_TASK = 8
#: Hashes whose bits are counted in 16-bit lanes without overflow.
LANE_ROWS = (1 << 16) - 1
QUARTERS = 4


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a slice of texts, and the number of shingles of each text."""
    found = find_words(data, offsets, PLAIN, lower=True)
    inside = PLAIN[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.cumsum(keep) - 1
    # All words, one blank behind each, so that a shingle is one run of bytes.
    body = np.where(inside, LOWER[data], np.uint8(0x20))[keep].tobytes()
    counts = np.diff(found.first)
    shingles = np.where(counts, np.maximum(counts - words + 1, 1), 0)
    ends = np.cumsum(shingles)
    at = np.repeat(found.first[:-1] - (ends - shingles), shingles) + np.arange(ends[-1] if len(ends) else 0)
    last = np.minimum(at + words, np.repeat(found.first[1:], shingles)) - 1
    start, end = place[found.start[at]], place[found.end[last] - 1] + 1
    digest, view = xxhash.xxh64_intdigest, memoryview(body)
    return np.fromiter((digest(view[a:b], SEED) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(at)), shingles


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of every text: ``counts`` says how many of the hashes are its own, in order."""
    ends = np.cumsum(counts)
    first = ends - counts
    pieces = -(-counts // LANE_ROWS)
    owner = np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    total = np.zeros((len(counts), 64), np.int64)
    if len(owner):
        cuts = first[owner] + nth * LANE_ROWS
        lanes, mask = np.empty((len(cuts), 16), np.uint64), np.uint64(0x0001000100010001)
        for bit in range(16):
            lanes[:, bit] = np.add.reduceat((hashes >> np.uint64(bit)) & mask, cuts)
        # Lane j of shift b counts bit b + 16 j.
        counted = lanes.view(np.uint16).reshape(-1, 16, 4).transpose(0, 2, 1).reshape(-1, 64)
        np.add.at(total, owner, counted.astype(np.int64))
    bits = 2 * total > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel() if len(counts) else np.zeros(0, np.uint64)


def _printed(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                prints = majority_bits(*shingle_hashes(data, offsets, words))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(prints.view(np.int64), pa.int64())], ["key", "fingerprint"])

    return work


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key`` and ``fingerprint`` (a long, its bits as they are) of every row."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(_printed(words), f"key {source.schema['key'].dataType.simpleString()}, fingerprint bigint")


def _quarter(k: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fingerprint", 16 * k).bitwiseAND(F.lit(0xFFFF)))


def _counts(prints: np.ndarray) -> np.ndarray:
    """Population counts, one row each: of the whole, then of the quarters."""
    quarters = [np.bitwise_count((prints >> np.uint64(16 * k)) & np.uint64(0xFFFF)) for k in range(QUARTERS)]
    return np.stack([np.bitwise_count(prints), *quarters]).astype(np.int16)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered fingerprints in rows of at most ``TILE``, named by their first."""
    held, rows = [], 0

    def tile(prints: np.ndarray) -> pa.RecordBatch:
        counts = _counts(prints)
        return pa.RecordBatch.from_pydict({
            "tile": pa.array(prints[:1].view(np.int64), pa.int64()), "low": pa.array([counts.min(axis=1).tolist()], pa.list_(pa.int32())),
            "high": pa.array([counts.max(axis=1).tolist()], pa.list_(pa.int32())), "body": pa.array([prints.tobytes()], pa.binary()),
        })

    for batch in batches:
        held.append(batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64))
        rows += len(held[-1])
        while rows >= TILE:
            whole = np.concatenate(held)
            yield tile(whole[:TILE])
            held, rows = [whole[TILE:]], rows - TILE
    if rows:
        yield tile(np.concatenate(held))


def _runs(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of ``LEAF`` fingerprints begin, with the least and largest of their counts."""
    cuts = np.arange(0, len(prints), LEAF)
    counts = _counts(prints)
    return cuts, np.minimum.reduceat(counts, cuts, axis=1), np.maximum.reduceat(counts, cuts, axis=1)


def close_pairs(one: np.ndarray, two: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """Edges (2 rows) that span every component of the links between two tiles; places in ``two``
    stand behind those in ``one``, unless both are the ``same``."""
    cuts, low_1, high_1 = _runs(one)
    cuts_2, low_2, high_2 = _runs(two)
    behind = 0 if same else len(one)
    found: list[np.ndarray] = []
    wide = max(1, STEP // (LEAF * LEAF))
    apart, bits = np.empty(STEP, np.uint64), np.empty(STEP, np.uint8)
    for k, first in enumerate(cuts.tolist()):
        gaps = np.maximum(np.maximum(low_1[:, k, None] - high_2, low_2 - high_1[:, k, None]), 0)
        near = np.flatnonzero(np.maximum(gaps[0], gaps[1:].sum(axis=0)) <= radius)
        if same:
            near = near[near >= k]
        mine = one[first : first + LEAF]
        for at in range(0, len(near), wide):
            places = (cuts_2[near[at : at + wide], None] + np.arange(LEAF)).ravel()
            places = places[places < len(two)]
            shape, cells = (len(mine), len(places)), len(mine) * len(places)
            np.bitwise_xor(mine[:, None], two[places][None, :], out=apart[:cells].reshape(shape))
            np.bitwise_count(apart[:cells], out=bits[:cells])
            row, column = np.divmod(np.flatnonzero(bits[:cells] <= radius), len(places))
            left, right = row + first, places[column] + behind
            if same:
                once = left < right
                left, right, row = left[once], right[once], row[once]
            if len(left):
                # What a row meets is connected through the row: a chain says the same as a star, and
                # rows of a group of near copies have most of it in common.
                again = np.flatnonzero(row[1:] == row[:-1]) + 1
                left[again] = right[again - 1]
                found.append(np.unique(left.astype(np.int64) << 32 | right))
    return _forest(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))


def _forest(codes: np.ndarray) -> np.ndarray:
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (above := up.setdefault(root, root)) != root:
            root = above
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    kept = []
    for code in codes.tolist():
        a, b = find(code >> 32), find(code & 0xFFFFFFFF)
        if a != b:
            up[max(a, b)] = min(a, b)
            kept.append(code)
    edges = np.array(kept, np.int64)
    return np.stack([edges >> 32, edges & 0xFFFFFFFF])


def _compared(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = np.frombuffer(batch.column("body_1")[k].as_buffer(), np.uint64)
                two = np.frombuffer(batch.column("body_2")[k].as_buffer(), np.uint64)
                same = batch.column("one")[k].as_py() == batch.column("two")[k].as_py()
                edges = close_pairs(one, two, same, radius)
                names = (one if same else np.concatenate([one, two])).view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": pa.array(names[edges[0]], pa.int64()), "b": pa.array(names[edges[1]], pa.int64())})

    return work


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles (``one`` <= ``two``) whose population counts differ by the radius at most."""
    small = tiles.select("tile", "low", "high")
    whole = F.explode(F.sequence(F.col("low")[0], F.col("high")[0]))
    reach = F.explode(F.sequence(F.col("low")[0] - radius, F.col("high")[0] + radius))
    mine = small.select(F.col("tile").alias("one"), F.col("low").alias("low_1"), F.col("high").alias("high_1"), whole.alias("count"))
    theirs = small.select(F.col("tile").alias("two"), F.col("low").alias("low_2"), F.col("high").alias("high_2"), reach.alias("count"))
    gap = lambda k: F.greatest(F.col("low_1")[k] - F.col("high_2")[k], F.col("low_2")[k] - F.col("high_1")[k], F.lit(0))
    quarters = sum((gap(k) for k in range(2, 1 + QUARTERS)), gap(1))
    met = mine.join(theirs, "count").filter((F.col("one") <= F.col("two")) & (quarters <= radius))
    return met.select("one", "two").distinct()


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that span every component of distinct ``fingerprint`` values within ``radius`` bits."""
    spark = prints.sparkSession
    n = prints.count()
    order = [F.bit_count("fingerprint"), *(_quarter(k) for k in range(QUARTERS - 1)), F.col("fingerprint")]
    dealt = prints.repartitionByRange(max(1, -(-n // TILE)), *order).sortWithinPartitions(*order)
    tiles = cut_lineage(dealt.mapInArrow(_tiles, "tile bigint, low array<int>, high array<int>, body binary"), "tiles")
    pairs = cut_lineage(tile_pairs(tiles, radius), "tile_pairs")
    parts = max(shuffle_width(spark), -(-pairs.count() // PAIRS_OF_TASK))
    body = tiles.select("tile", "body")
    one = pairs.join(body, pairs.one == body.tile).select("one", "two", F.col("body").alias("body_1")).repartition(parts, "one", "two")
    two = pairs.join(body, pairs.two == body.tile).select("one", "two", F.col("body").alias("body_2")).repartition(parts, "one", "two")
    return one.join(two, ["one", "two"]).mapInArrow(_compared(radius), "a bigint, b bigint")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row: its fingerprint as 16 hexadecimal digits and the smallest id it is linked with."""
    named = cut_lineage(fingerprints(docs, key, text, words), "prints")
    classes = cut_lineage(named.groupBy("fingerprint").agg(F.min("key").alias("least")), "classes")
    roots = cut_lineage(components(links(classes.select("fingerprint"), radius)), "roots")
    rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.select("fingerprint", "root").join(of_root, "root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return named.join(of_class, "fingerprint", "left").select(F.col("key").alias(key), digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, columns as they were, whose id is the smallest of their component. Rows
    that share that id stay together; rows without an id stay."""
    ids = report(docs, key, text, words, radius).select(F.col(f"`{key}`").alias("id"), "component_id")
    kept = ids.filter(F.col("id") == F.col("component_id")).select("id").distinct()
    column = docs[f"`{key}`"]
    return docs.filter(column.isNull()).union(docs.join(kept, column.eqNullSafe(F.col("id")), "left_semi"))
