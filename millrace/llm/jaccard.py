"""Exact Jaccard self-join of shingle sets with signature trees, down to linked groups.

Two documents link when ``100 * |A & B| >= PERCENT * |A | B|``. Documents with equal sets are one
class from the start; what follows sees each different set once.

1. Prefixes. In any fixed order of the shingles two linked sets share one of the first
   ``n - ceil(t * n) + 1`` of either. The order puts frequent shingles last (counted over all
   texts; their number is bounded, and the order only decides how much work there is) and goes by
   hash otherwise. Classes that share a prefix shingle are a block; blocks with the same members
   count once.
2. Trees. Inside a block the classes lie in a tree by size. A leaf entry is the bitmap of a set,
   a node has the OR of the bitmaps below it and the range of their sizes. Two sets share at most
   the bits common to their bitmaps, and what fell on taken bits in the smaller excess; two nodes at
   most that of their ORs with their largest excess. A walk over pairs of nodes drops those whose
   largest possible overlap is below what their smallest sizes need.
3. Spanning tests. A walk joins what it may not drop in a forest, so a block gives fewer tests than
   members, however many of its pairs are close. Tested pairs are compared as exact sets; those that
   link make first components. ``SPANNING`` such rounds, each over what is still apart and in another
   order, bring close groups together.
4. Closing walk. Classes that passed any walk are walked again; now pairs of one component are
   dropped, and every other pair that the trees cannot rule out is tested, in the first of the blocks
   that both are in. So no link between different components is missed.

Blocks larger than ``NODE`` classes are split by size band and by hash; pairs of parts are walked
by different tasks. Bitmaps that filter a scan have a fixed size.

Shingles stand as 64-bit hashes, and so do sets: two given different ones agree with probability
2**-64.

Defined results: a null text has no words; without words a set is empty, links with nothing and is
its own component; a text of fewer words than a shingle is one shingle; a null id never names a
component that has another id; repeated rows are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bitmaps import Bitmap, bitmap
from millrace.llm.components import components
from millrace.llm.names import named, packed_row, unpacked_row
from millrace.llm.texts import PLAIN, binary_column, find_words, mix, release, run_hashes, slices
from millrace.session import cut_lineage

WORDS = 4
PERCENT = 85
#: A shingle in so many chunks' worth of texts is frequent; at most ``FREQUENT`` of them are told apart.
HEAVY, HEAVY_IN_CHUNK, FREQUENT = 64, 8, 100_000
CHUNK = 1 << 21
#: Bits per shingle in a set's bitmap (rounded up to a power of two), and its longest bitmap.
BITS_PER_SHINGLE, LONGEST = 2, 1 << 20
NODE = 4096
LEAF, FANOUT = 32, 8
SPANNING = 2
#: Rows worked on together when blocks are small.
TOGETHER = 8192


class Rule:
    """What links: shingle width and percentage."""

    def __init__(self, words: int = WORDS, percent: int = PERCENT):
        # Bitmaps of sets of one and of two neighbouring widths are compared: half of the union is the least.
        if words < 1 or not 50 <= percent <= 100:
            raise ValueError("a rule needs a word at least and 50 to 100 percent")
        self.words, self.percent = words, percent

    def prefix(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def least_overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The smallest intersection with which sizes a and b link."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a slice."""
    found = find_words(data, offsets, PLAIN, lower=True)
    hashes = found.hashes()
    starts = np.arange(max(0, len(hashes) - words + 1))
    runs = run_hashes(hashes, starts, starts + words)
    out = []
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if high - low >= words:
            out.append(np.unique(runs[low : high - words + 1]))
        else:
            out.append(run_hashes(hashes, np.array([low]), np.array([high])) if high > low else np.zeros(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int:
    """A hash of a set: of its size and of all its members, in order."""
    size = np.array([len(shingles)])
    return int(run_hashes(shingles, np.zeros(1, np.int64), size).view(np.int64)[0]) if len(shingles) else 0


def bits_of(shingles: np.ndarray) -> bytes:
    width = min(LONGEST, max(64, 1 << int(BITS_PER_SHINGLE * len(shingles) - 1).bit_length())) if len(shingles) else 64
    spots = np.zeros(width, bool)
    spots[(mix(shingles) % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(spots, bitorder="little").tobytes()


def _frequent(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            shingle, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= HEAVY_IN_CHUNK
            return pa.RecordBatch.from_pydict({"shingle": pa.array(shingle[keep].view(np.int64)), "n": pa.array(n[keep], pa.int64())})

        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                held += sets_of(data, offsets, words)
                size = sum(map(len, held)) if len(held) < 64 else size + sum(map(len, held[-len(offsets) + 1 :]))
                if size >= CHUNK:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return scan


def _described(rule: Rule, heavy: np.ndarray, weight: np.ndarray):
    def prefix_of(shingles: np.ndarray) -> np.ndarray:
        size = rule.prefix(len(shingles))
        if len(heavy):
            at = np.minimum(np.searchsorted(heavy, shingles), len(heavy) - 1)
            known = heavy[at] == shingles
            if known.any():
                return shingles[np.lexsort((shingles, np.where(known, weight[at], 0)))[:size]]
        return shingles[:size]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                sets = sets_of(data, offsets, rule.words)
                prefixes = [prefix_of(s) if len(s) else s for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
                flat = np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("key"), "n": pa.array([len(s) for s in sets], pa.int64()), "class": pa.array([class_of(s) for s in sets], pa.int64()),
                    "prefix": pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64())),
                    "bits": binary_column([bits_of(s) for s in sets]),
                })

    return describe


def _shared_prefixes(shared: Bitmap):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            some = shared.marked(flat)
            rows = pa.array(owner[some])
            yield pa.RecordBatch.from_pydict({"shingle": pa.array(flat[some]), "class": batch.column("class").take(rows), "n": batch.column("n").take(rows)})

    return keep


def _chosen_sets(rule: Rule, wanted: Bitmap):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                sets = [s for s in sets_of(data, offsets, rule.words) if len(s)]
                names = np.array([class_of(s) for s in sets], np.int64)
                keep = np.flatnonzero(wanted.marked(names)) if len(names) else np.zeros(0, np.int64)
                chosen = [sets[i] for i in keep]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in chosen])])
                flat = np.concatenate([*chosen, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "class": pa.array(names[keep], pa.int64()),
                    "shingles": pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64())),
                })

    return scan


class Forest:
    """Union-find over the members of one block."""

    def __init__(self, groups: np.ndarray):
        _, self.up = np.unique(groups, return_inverse=True)
        first = {}
        self.up = np.array([first.setdefault(g, i) for i, g in enumerate(self.up.tolist())], np.int64)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def roots(self, members: np.ndarray) -> np.ndarray:
        out = self.up[members]
        while (self.up[out] != out).any():
            out = self.up[out]
        return out

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps brought to a smaller power-of-two width: bits whose places agree there are ORed."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class Tree:
    """A signature tree over members in order of size: levels of nodes, leaves first."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.excess = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        cuts = np.arange(0, len(sizes), LEAF)
        level = {
            "low": np.minimum.reduceat(sizes, cuts), "high": np.maximum.reduceat(sizes, cuts),
            "excess": np.maximum.reduceat(self.excess, cuts), "bits": np.bitwise_or.reduceat(bits, cuts, axis=0),
        }
        self.levels = [level]
        while len(level["low"]) > 1:
            cuts = np.arange(0, len(level["low"]), FANOUT)
            level = {
                "low": np.minimum.reduceat(level["low"], cuts), "high": np.maximum.reduceat(level["high"], cuts),
                "excess": np.maximum.reduceat(level["excess"], cuts), "bits": np.bitwise_or.reduceat(level["bits"], cuts, axis=0),
            }
            self.levels.append(level)

    def children(self, depth: int, node: int) -> range:
        step = FANOUT if depth else LEAF
        below = len(self.levels[depth - 1]["low"]) if depth else len(self.sizes)
        return range(node * step, min(below, (node + 1) * step))


def _may_link(rule: Rule, a: dict, i: np.ndarray, b: dict, j: np.ndarray) -> np.ndarray:
    """Whether sets of the given sizes, excesses and bitmaps (or any below two nodes) may link."""
    most = np.bitwise_count(a["bits"][i] & b["bits"][j]).sum(axis=-1, dtype=np.int64) + np.minimum(a["excess"][i], b["excess"][j])
    most = np.minimum(most, np.minimum(a["high"][i], b["high"][j]))
    low_a, low_b = a["low"][i], b["low"][j]
    # Sizes must be able to link too: the smaller is at least t times the larger.
    fits = (100 * a["high"][i] >= rule.percent * low_b) & (100 * b["high"][j] >= rule.percent * low_a)
    return fits & (most >= rule.least_overlap(low_a, low_b))


def _walk(rule: Rule, left: Tree, right: Tree, same: bool):
    """Pairs of leaves (as member ranges) that may hold linked members, by a walk from both roots."""
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        dl, nl, dr, nr = stack.pop()
        i, j = np.array([nl]), np.array([nr])
        if not _may_link(rule, left.levels[dl], i, right.levels[dr], j)[0]:
            continue
        if dl == 0 and dr == 0:
            yield np.arange(left.children(0, nl).start, left.children(0, nl).stop), np.arange(right.children(0, nr).start, right.children(0, nr).stop)
        elif dl >= dr:
            for child in left.children(dl, nl):
                if same and dl == dr:
                    for other in right.children(dr, nr):
                        if other >= child:
                            stack.append((dl - 1, child, dr - 1, other))
                else:
                    stack.append((dl - 1, child, dr, nr))
        else:
            for other in right.children(dr, nr):
                stack.append((dl, nl, dr - 1, other))


def _entries(tree: Tree) -> dict:
    return {"low": tree.sizes, "high": tree.sizes, "excess": tree.excess, "bits": tree.bits}


def _met_before(blocks: list[np.ndarray], here: int) -> np.ndarray:
    """A bit per member and block before this one that it is in: members with a common bit meet there."""
    before = [b[b < here] for b in blocks]
    names = np.unique(np.concatenate([*before, np.zeros(0, np.int64)]))
    out = np.zeros((len(blocks), max(1, -(-len(names) // 8))), np.uint8)
    if len(names):
        owner = np.repeat(np.arange(len(blocks)), [len(b) for b in before])
        place = np.searchsorted(names, np.concatenate(before))
        np.bitwise_or.at(out, (owner, place >> 3), (1 << (place & 7)).astype(np.uint8))
    return out


def block_pairs(
    rule: Rule, sizes: np.ndarray, bits: list[bytes], groups: np.ndarray, side: np.ndarray, spanning: bool,
    before: np.ndarray | None = None, seed: int = 0,
) -> list[tuple[int, int]]:
    """Pairs of members of one block that may link and are in different ``groups``; members with
    ``side`` 1 are not paired with each other (their own part does that), nor those with side 0 if
    any has side 1. ``spanning``: only a forest of them, another one for every ``seed``. ``before`` (see
    ``_met_before``): not those that meet in an earlier block."""
    forest = Forest(groups)
    width = np.array([len(b) // 8 for b in bits])
    two_sided = bool(side.any())
    out: list[tuple[int, int]] = []

    def tree(members: np.ndarray, words: int) -> Tree:
        rows = np.stack([fold(np.frombuffer(bits[m], np.uint64), words) for m in members])
        return Tree(sizes[members], rows)

    def walk(a: np.ndarray, b: np.ndarray, words: int, same: bool) -> None:
        if not len(a) or not len(b):
            return
        left = tree(a, words)
        right = left if same else tree(b, words)
        for x, y in _walk(rule, left, right, same):
            i, j = np.repeat(x, len(y)), np.tile(y, len(x))
            if same:
                i, j = i[i < j], j[i < j]
            open_pairs = forest.roots(a[i]) != forest.roots(b[j])
            if before is not None:
                open_pairs[open_pairs] = ~(before[a[i[open_pairs]]] & before[b[j[open_pairs]]]).any(axis=1)
            i, j = i[open_pairs], j[open_pairs]
            if not len(i):
                continue
            ok = _may_link(rule, _entries(left), i, _entries(right), j)
            for m, n in zip(a[i[ok]].tolist(), b[j[ok]].tolist(), strict=True):
                if not spanning or forest.union(m, n):
                    out.append((m, n))

    order = np.lexsort((np.random.Generator(np.random.PCG64(seed)).permutation(len(sizes)), sizes))
    widths = np.unique(width)
    for w in widths:
        for wider in (w, 2 * w):
            a, b = order[width[order] == w], order[width[order] == wider]
            if two_sided:
                walk(a[side[a] == 0], b[side[b] == 1], w, False)
                if wider != w:
                    walk(a[side[a] == 1], b[side[b] == 0], w, False)
            else:
                walk(a, b, w, wider == w)
    return out


def _small_pairs(rule: Rule, sizes: np.ndarray, bits: list[bytes], groups: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the given pairs of members may link, all worked out at once by bitmap width."""
    width = np.array([len(b) // 8 for b in bits])
    ok = np.zeros(len(i), bool)
    shared = np.minimum(width[i], width[j])
    near = (np.maximum(width[i], width[j]) <= 2 * shared) & (groups[i] != groups[j])
    for w in np.unique(shared[near]):
        some = np.flatnonzero(near & (shared == w))
        members, at = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
        rows = np.stack([fold(np.frombuffer(bits[m], np.uint64), int(w)) for m in members])
        size = sizes[members]
        entry = {"low": size, "high": size, "excess": size - np.bitwise_count(rows).sum(axis=1, dtype=np.int64), "bits": rows}
        ok[some] = _may_link(rule, entry, at[: len(some)], entry, at[len(some) :])
    return ok


def _walked(rule: Rule, spanning: bool, seed: int):
    """Rows sorted by block and part: (a, b) class pairs to test."""

    def work(table: pa.Table) -> pa.RecordBatch:
        names = table.column("class").to_numpy()
        sizes, groups = table.column("n").to_numpy(), table.column("group").to_numpy()
        bits = table.column("bits").to_pylist()
        side = table.column("side").to_numpy()
        block = np.stack([table.column("shingle").to_numpy(), table.column("unit").to_numpy()])
        blocks = [] if spanning else [np.array(b, np.int64) for b in table.column("blocks").to_pylist()]
        cuts = np.concatenate([[0], np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0)) + 1, [len(names)]])
        left, right = [], []
        count = np.diff(cuts)
        small = (count <= 8) & (np.maximum.reduceat(side, cuts[:-1]) == 0)
        end = np.where(np.repeat(small, count), np.repeat(cuts[1:], count), -1)
        for step in range(1, 8):
            i = np.flatnonzero(np.arange(len(names)) + step < end)
            ok = _small_pairs(rule, sizes, bits, groups, i, i + step)
            left.append(i[ok])
            right.append(i[ok] + step)
        for low, high in zip(cuts[:-1][~small].tolist(), cuts[1:][~small].tolist(), strict=True):
            before = None if spanning else _met_before(blocks[low:high], int(block[0, low]))
            pairs = block_pairs(rule, sizes[low:high], bits[low:high], groups[low:high], side[low:high], spanning, before, abs(int(block[0, low])) + seed)
            found = np.array(pairs, np.int64).reshape(-1, 2) + low
            left.append(found[:, 0])
            right.append(found[:, 1])
        a, b = names[np.concatenate(left)], names[np.concatenate(right)]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_pydict({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < TOGETHER:
                continue
            # The last block may go on in the next batch.
            table = pa.Table.from_batches(held).combine_chunks()
            shingle, unit = table.column("shingle").to_numpy(), table.column("unit").to_numpy()
            ended = np.flatnonzero((shingle != shingle[-1]) | (unit != unit[-1]))
            if len(ended):
                cut = int(ended[-1]) + 1
                yield work(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return walk


def _band(size: Column, rule: Rule) -> Column:
    """Sizes that may link lie in the same or in neighbouring bands."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100.0 / rule.percent)) + 1e-9).cast("int")


def _dealt(members: DataFrame, rule: Rule) -> DataFrame:
    """``unit`` and ``side`` for every member: a block of up to ``NODE`` classes is one unit; of a
    larger one, parts by size band and hash make units with themselves and with every part they may
    link with. Members are small rows here; their bitmaps come later."""
    counts = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("members"))
    sized = cut_lineage(members.join(counts, "shingle"), "sized")
    plain = sized.filter(F.col("members") <= NODE).withColumn("unit", F.lit(0).cast("long")).withColumn("side", F.lit(0))
    large = sized.filter(F.col("members") > NODE).withColumn("band", _band(F.col("n"), rule))
    bands = large.groupBy("shingle", "band").agg(F.ceil(F.count(F.lit(1)) / NODE).cast("int").alias("parts"))
    other = bands.select(F.col("shingle").alias("s2"), F.col("band").alias("band2"), F.col("parts").alias("parts2"))
    own = large.join(bands, ["shingle", "band"]).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    near = own.join(other, (F.col("shingle") == F.col("s2")) & (F.abs(F.col("band") - F.col("band2")) <= 1))
    near = near.withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)))
    mine, theirs = F.struct(F.col("band").alias("b"), F.col("part").alias("p")), F.struct(F.col("band2").alias("b"), F.col("part2").alias("p"))
    low, high = F.least(mine, theirs), F.greatest(mine, theirs)
    spread = near.withColumn("unit", F.xxhash64(low, high)).withColumn("side", F.when(mine <= theirs, 0).otherwise(1))
    columns = [*members.columns, "unit", "side"]
    return plain.select(*columns).unionByName(spread.select(*columns))


def _tests(members: DataFrame, entries: DataFrame, rule: Rule, spanning: bool, seed: int = 0) -> DataFrame:
    """Distinct pairs of classes (a < b) to compare; ``members`` has shingle, class, n and group,
    ``entries`` the bitmap of every class."""
    dealt = _dealt(members, rule).join(entries, "class")
    if not spanning:
        # No longer than a prefix.
        dealt = dealt.join(members.groupBy("class").agg(F.collect_set("shingle").alias("blocks")), "class")
    rows = dealt.repartition("shingle", "unit").sortWithinPartitions("shingle", "unit", "n", "class")
    rows = rows.select("shingle", "unit", "side", "class", "n", "bits", "group", *([] if spanning else ["blocks"]))
    return rows.mapInArrow(_walked(rule, spanning, seed), "a bigint, b bigint").distinct()


def _still_apart(members: DataFrame, passed: DataFrame, edges: DataFrame) -> DataFrame:
    """The members that passed a walk, with their component so far as ``group``, in the blocks that
    hold more than one component."""
    known = components(edges).withColumnRenamed("node", "class")
    again = members.join(passed, "class").join(known, "class", "left").withColumn("group", F.coalesce("root", "class")).drop("root")
    apart = again.groupBy("shingle").agg(F.min("group").alias("l"), F.max("group").alias("h")).filter(F.col("l") != F.col("h"))
    return cut_lineage(again.join(apart.select("shingle"), "shingle"), "apart")


def _linked(tests: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The tested pairs whose sets link."""
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    met = tests.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return met.filter(100 * common >= rule.percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """``key``, ``n`` (set size), ``class`` and ``root`` (equal for all documents of a component; null
    for empty sets) of every row of ``docs``."""
    rule = rule or Rule()
    source = docs.select(named(key).alias("key"), named(text).alias("text"))
    counted = source.select("text").mapInArrow(_frequent(rule.words), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= HEAVY).orderBy(F.col("n").desc(), "shingle").limit(FREQUENT).collect()
    top.sort(key=lambda r: np.int64(r.shingle).view(np.uint64))
    heavy = np.array([r.shingle for r in top], np.int64).view(np.uint64)
    weight = np.log2(np.array([r.n for r in top], float)).astype(np.int64) if top else np.zeros(0, np.int64)

    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n bigint, class bigint, prefix array<bigint>, bits binary"
    described = cut_lineage(source.mapInArrow(_described(rule, heavy, weight), schema), "sets")
    filled = described.filter(F.col("n") > 0)
    prefixes = filled.select("class", F.explode("prefix").alias("shingle"))
    shared = prefixes.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter(F.col("low") != F.col("high"))
    shared = cut_lineage(shared.select("shingle"), "shared")
    met = filled.select("class", "n", "prefix").mapInArrow(_shared_prefixes(bitmap(shared, "shingle")), "shingle bigint, class bigint, n bigint")
    met = cut_lineage(met.distinct().join(shared, "shingle"), "blocks")
    # Blocks with the same members are walked once: they agree in number, sum and xor.
    alike = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("class").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("class")).alias("x"))
    once = alike.groupBy("c", "s", "x").agg(F.min("shingle").alias("shingle")).select("shingle")
    members = cut_lineage(met.join(once, "shingle"), "members")
    entries = filled.select("class", "bits").dropDuplicates(["class"])

    tests = cut_lineage(_tests(members.withColumn("group", F.col("class")), entries, rule, spanning=True), "tests")
    passed = cut_lineage(tests.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "passed")
    chosen = source.select("text").mapInArrow(_chosen_sets(rule, bitmap(passed, "class")), "class bigint, shingles array<bigint>")
    sets = cut_lineage(chosen.dropDuplicates(["class"]).join(passed, "class", "left_semi"), "shingles")
    edges = cut_lineage(_linked(tests, sets, rule), "links")
    for seed in range(1, SPANNING):
        apart = _still_apart(members, passed, edges)
        fresh = cut_lineage(_tests(apart, entries, rule, True, seed).join(tests, ["a", "b"], "left_anti"), "tests")
        edges = cut_lineage(edges.unionByName(_linked(fresh, sets, rule)), "links")
        tests = tests.unionByName(fresh)
    rest = _tests(_still_apart(members, passed, edges), entries, rule, spanning=False)
    more = _linked(rest.join(tests, ["a", "b"], "left_anti"), sets, rule)
    roots = components(edges.unionByName(more))

    rooted = described.select("key", "n", "class").join(roots.withColumnRenamed("node", "class"), "class", "left")
    return rooted.select("key", "n", "class", F.when(F.col("n") > 0, F.coalesce("root", "class")).alias("root"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """Per row: the size of its set, the smallest id of its component and its class."""
    linked = cut_lineage(link(docs, key, text, rule), "linked")
    least = linked.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("key").alias("least"))
    rows = linked.join(least, "root", "left")
    return rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"), F.col("class").alias("class_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule | None = None) -> DataFrame:
    """The rows of ``docs``, columns as they were, that have the smallest id of their component (of
    equal ids the one with the smallest digest); of rows with equal id and text one. Rows with an
    empty set all stay, but for such repetitions."""
    own, body = named(key), F.coalesce(named(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(own.cast("string"), F.lit("")), body)))
    whole = docs.select(packed_row(docs).alias("row"), digest.alias("digest"))
    source = docs.select(F.struct(own.isNull().alias("none"), own.alias("id"), digest.alias("digest")).alias("name"), named(text).alias("body"))
    linked = cut_lineage(link(source, "name", "body", rule), "linked")
    alone = linked.filter(F.col("root").isNull()).select("key.digest")
    least = linked.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("key").alias("key")).select("key.digest")
    kept = alone.unionByName(least).distinct()
    once = Window.partitionBy("digest").orderBy("digest")
    rows = whole.join(kept, "digest", "left_semi").withColumn("at", F.row_number().over(once)).filter(F.col("at") == 1)
    return rows.select(*unpacked_row(docs))
