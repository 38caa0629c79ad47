"""Random forests whose nodes stay off the driver.

MLlib keeps every node of a forest on the driver, and without a depth limit the nodes grow with the rows.
Here rows are cut into bins once and lie in blocks; a tree's top is grown from histograms that all tasks
add up, until a node holds at most ``SUBTREE_ROWS`` rows of the tree's sample. From there a task grows the
subtree and writes it to a table. The driver holds the tops alone: some nodes for every ``SUBTREE_ROWS``
rows of a tree.

The rules are MLlib's: ``bins`` bins a column at most, samples with replacement (Poisson counts), a fresh
choice of columns at every node, Gini impurity, the first best split, a leaf where nothing is gained, and
sibling leaves that predict the same class made one. The bins come of all rows, MLlib's of a sample; samples
and choices of columns come of other random numbers than MLlib's. They are drawn by place (block, tree, and
number of the node), so a forest does not depend on where its nodes are grown.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Rows of a block; places in it are 16-bit numbers.
BLOCK = 10_000
#: A node with at most so many rows is grown on in one task.
SUBTREE_ROWS = 1_000_000
#: Nodes whose histograms are looked at together.
NODES_AT_ONCE = 2048
#: Bytes of a batch of dealt rows.
BATCH_BYTES = 1 << 22

BLOCKS = "block bigint, bins binary, labels array<double>"
DEALT = "tree int, node int, block bigint, at binary, data binary"

OPEN, SPLIT, SUBTREE, LEAF = range(4)


class Layout(NamedTuple):
    seed: int
    trees: int
    columns: int
    bins: int
    classes: int
    chosen: int
    least: int
    depth: int


def thresholds(rows: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Per column the numbers that part its bins, each midway between two neighbouring values: all of them
    where there are ``bins`` values or fewer, else those at equal shares of the rows."""
    pairs = {}
    for c in columns:
        seen = sorted(r[0] for r in rows.select(c).distinct().limit(bins + 1).collect())
        if len(seen) <= bins:
            pairs[c] = list(zip(seen, seen[1:], strict=False))
    many = [c for c in columns if c not in pairs]
    if many:
        shares = [i / bins for i in range(1, bins)]
        row = rows.agg(*[F.percentile_approx(c, shares, 10000).alias(c) for c in many]).first()
        low = [(c, x) for c in many for x in sorted(set(row[c]))]
        high = rows.agg(*[F.min(F.when(F.col(c) > x, F.col(c))).alias(str(i)) for i, (c, x) in enumerate(low)]).first()
        for c in many:
            pairs[c] = [(x, y) for (name, x), y in zip(low, high, strict=True) if name == c and y is not None]
    return [np.array([x + (y - x) / 2 for x, y in pairs[c]], "float64") for c in columns]


def _blocks(cuts: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows as blocks: a byte a column, the number of its bin."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            *values, labels = batch.columns
            bins = np.column_stack([np.searchsorted(c, v.to_numpy(zero_copy_only=False), "left").astype(np.uint8) for c, v in zip(cuts, values, strict=True)])
            for start in range(0, len(bins), BLOCK):
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number], pa.int64()), "bins": pa.array([bins[start : start + BLOCK].tobytes()], pa.binary()),
                    "labels": pa.array([labels[start : start + BLOCK].to_pylist()], pa.list_(pa.float64())),
                })
                number += 1

    return cut


def _counts(layout: Layout, tree: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the tree's sample."""
    return np.random.default_rng([layout.seed, tree, block]).poisson(1.0, rows).astype(np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _choice(layout: Layout, tree: int, numbers: np.ndarray) -> np.ndarray:
    """The columns that each node may be split by, in random order. Nodes are numbered 1 for the root, 2n and 2n + 1 below n."""
    if layout.chosen == layout.columns:
        return np.tile(np.arange(layout.columns), (len(numbers), 1))
    step = np.uint64(0x9E3779B97F4A7C15)
    start = _mix(np.array([layout.seed], np.uint64) * step + np.uint64(tree + 1))
    drawn = _mix(_mix(start + numbers.astype(np.uint64) * step)[:, None] + np.arange(1, layout.columns + 1, dtype=np.uint64) * step)
    return np.argsort(drawn, axis=1, kind="stable")[:, : layout.chosen]


def _histograms(layout: Layout, choice: np.ndarray, slot: np.ndarray, bins: np.ndarray, label: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sampled rows by node, chosen column, bin and class."""
    nodes, chosen = choice.shape
    cells = nodes * chosen * layout.bins * layout.classes
    total, row = np.zeros(cells), np.arange(len(slot))
    for j in range(chosen):
        cell = ((slot * chosen + j) * layout.bins + bins[row, choice[slot, j]]) * layout.classes + label
        total += np.bincount(cell, weights=count, minlength=cells)
    return total.reshape(nodes, chosen, layout.bins, layout.classes)


def _impurity(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    impurity = np.ones(counts.shape[:-1])
    for k in range(counts.shape[-1]):
        impurity -= (counts[..., k] / rows) ** 2
    return impurity


def _best(layout: Layout, histograms: np.ndarray, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, bin, counts of the left side) of the best split of every node; column -1 where none gains."""
    sums = histograms.cumsum(axis=2)
    left, total = sums[:, :, :-1], sums[:, :, -1:]
    right = total - left
    n_left, n_right, n = left.sum(-1), right.sum(-1), total.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(total, n) - n_left / n * _impurity(left, n_left) - n_right / n * _impurity(right, n_right)
    gain = np.where((n_left >= layout.least) & (n_right >= layout.least), gain, -1.0).reshape(len(choice), -1)
    node, at = np.arange(len(choice)), gain.argmax(axis=1)
    which, split = at // (layout.bins - 1), at % (layout.bins - 1)
    return np.where(gain[node, at] > 0, choice[node, which], -1), split, left[node, which, split]


def _closed(layout: Layout, counts: np.ndarray, depth: int) -> np.ndarray:
    """Which nodes are leaves from the start: at the last depth, or of one class."""
    return (_impurity(counts, counts.sum(-1)) < np.finfo(float).eps) | (depth >= layout.depth)


def _grown(layout: Layout, tree: int, number: int, bins: np.ndarray, label: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(left child or -1, column, bin, counts by class) of the nodes of a subtree, the root first; the right
    child follows the left. Rows are kept in the order of their nodes, so a level is one pass over them."""
    levels, depth, first = [], number.bit_length() - 1, 0
    numbers, counts = np.array([number]), np.bincount(label, weights=count, minlength=layout.classes)[None, :]
    rows, sizes, closed = np.arange(len(label)), np.array([len(label)]), np.array([False])
    closed |= depth >= layout.depth
    while True:
        nodes = len(numbers)
        column, split, left = np.full(nodes, -1), np.zeros(nodes, int), np.zeros_like(counts)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        slot = np.repeat(np.arange(nodes), sizes)
        for low in range(0, nodes, NODES_AT_ONCE):
            those = low + np.flatnonzero(~closed[low : low + NODES_AT_ONCE])
            if not len(those):
                continue
            part = slice(ends[low], ends[min(low + NODES_AT_ONCE, nodes)])
            rank = np.full(NODES_AT_ONCE, -1)
            rank[those - low] = np.arange(len(those))
            place, r = rank[slot[part] - low], rows[part]
            choice = _choice(layout, tree, numbers[those])
            column[those], split[those], left[those] = _best(layout, _histograms(layout, choice, place, bins[r], label[r], count[r]), choice)
        parted = column >= 0
        below = np.full(nodes, -1)
        below[parted] = first + nodes + 2 * np.arange(parted.sum())
        levels.append((below, column, split, counts, parted))
        if not parted.any():
            break
        kept = parted[slot]
        rows, slot = rows[kept], (np.cumsum(parted) - 1)[slot[kept]]
        parents = np.flatnonzero(parted)
        right = bins[rows, column[parents][slot]] > split[parents][slot]
        first, depth = first + nodes, depth + 1
        numbers = (2 * numbers[parents][:, None] + [0, 1]).reshape(-1)
        counts = np.stack([left[parents], counts[parents] - left[parents]], axis=1).reshape(-1, layout.classes)
        child = 2 * slot + right
        sizes, closed = np.bincount(child, minlength=len(numbers)), _closed(layout, counts, depth)
        sizes, stays = np.where(closed, 0, sizes), ~closed[child]
        rows, child = rows[stays], child[stays]
        rows = rows[np.argsort(child, kind="stable")]
    return _pruned(levels)


def _pruned(levels: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sibling leaves of one class become one leaf, from the lowest level up; what hangs on no node goes."""
    below, column, split, counts, _ = (np.concatenate(x) for x in zip(*levels, strict=True))
    predicted, start = counts.argmax(axis=1), len(below)
    for level in reversed(levels):
        start -= len(level[0])
        inner = start + np.flatnonzero(level[-1])
        left = below[inner]
        same = (below[left] < 0) & (below[left + 1] < 0) & (predicted[left] == predicted[left + 1])
        below[inner[same]] = -1
    keep = np.zeros(len(below), bool)
    keep[0], start = True, 0
    for level in levels:
        here = start + np.flatnonzero(keep[start : start + len(level[0])])
        left = below[here][below[here] >= 0]
        keep[left] = keep[left + 1] = True
        start += len(level[0])
    moved = np.cumsum(keep) - 1
    below = below[keep]
    below = np.where(below >= 0, moved[below], -1)
    return below.astype(np.int32), np.maximum(column[keep], 0).astype(np.uint8), split[keep].astype(np.uint8), counts[keep].astype(np.uint32)


def _reached(below: np.ndarray, column: np.ndarray, split: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf that each row comes to."""
    node, moving = np.zeros(len(bins), int), np.arange(len(bins))
    while True:
        moving = moving[below[node[moving]] >= 0]
        if not len(moving):
            return node
        at = node[moving]
        node[moving] = below[at] + (bins[moving, column[at]] > split[at])


class Top:
    """The upper nodes of one tree, each open, split, the root of a subtree grown elsewhere, or a leaf."""

    def __init__(self, state: int):
        self.state, self.number, self.below, self.column, self.split, self.counts = [state], [1], [-1], [0], [0], [None]

    def part(self, layout: Layout, node: int, column: int, split: int, counts: np.ndarray, left: np.ndarray) -> None:
        """Take the best split of an open node."""
        self.counts[node] = counts
        if column < 0:
            self.state[node] = LEAF
            return
        self.state[node], self.below[node], self.column[node], self.split[node] = SPLIT, len(self.state), column, split
        for side, has in enumerate((left, counts - left)):
            number = 2 * self.number[node] + side
            closed = _closed(layout, has, number.bit_length() - 1)
            self.state.append(LEAF if closed else SUBTREE if has.sum() <= SUBTREE_ROWS else OPEN)
            self.number.append(number)
            self.counts.append(has)
            for to, value in ((self.below, -1), (self.column, 0), (self.split, 0)):
                to.append(value)

    def prune(self, leaves: set[int]) -> None:
        """``leaves``: the subtrees that are a leaf."""
        for node in leaves:
            self.state[node] = LEAF
        for node in reversed(range(len(self.state))):
            if self.state[node] == SPLIT:
                left, right = self.below[node], self.below[node] + 1
                if self.state[left] == self.state[right] == LEAF and self.counts[left].argmax() == self.counts[right].argmax():
                    self.state[node], self.below[node] = LEAF, -1

    def dealt(self, bins: np.ndarray, states: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
        """(node, rows that come to it), of the nodes in these states."""
        if len(self.state) == 1:
            yield from [(0, np.arange(len(bins)))] if self.state[0] in states else []
            return
        node = _reached(np.array(self.below), np.array(self.column), np.array(self.split), bins)
        order = np.argsort(node, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
            if len(rows) and self.state[node[rows[0]]] in states:
                yield int(node[rows[0]]), rows


def _read(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.Scalar]]:
    for batch in batches:
        for block, bins, labels in zip(*batch.columns, strict=True):
            yield block.as_py(), np.frombuffer(bins.as_py(), np.uint8).reshape(-1, layout.columns), labels


def _levelled(layout: Layout, tops: list[Top]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The histograms of all open nodes over a task's blocks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for block, bins, labels in _read(layout, batches):
            label = np.array(labels.as_py()).astype(int)
            for tree, top in enumerate(tops):
                if OPEN not in top.state:
                    continue
                count = _counts(layout, tree, block, len(label))
                drawn = np.flatnonzero(count)
                for node, rows in top.dealt(bins[drawn], (OPEN,)):
                    r, choice = drawn[rows], _choice(layout, tree, np.array([top.number[node]]))
                    one = _histograms(layout, choice, np.zeros(len(r), int), bins[r], label[r], count[r])
                    found[tree, node] = found[tree, node] + one if (tree, node) in found else one
        for (tree, node), histogram in found.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "data": pa.array([histogram.tobytes()], pa.binary())})

    return add


def _split(layout: Layout, tops: list[Top]) -> Callable[[tuple, pa.Table], pa.Table]:
    """The best split of a node from all tasks' histograms."""
    def best(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        choice = _choice(layout, tree, np.array([tops[tree].number[node]]))
        total = sum(np.frombuffer(h.as_py()) for h in table["data"]).reshape(1, layout.chosen, layout.bins, layout.classes)
        column, split, left = _best(layout, total, choice)
        return pa.table({
            "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "column": pa.array(column, pa.int32()), "split": pa.array(split, pa.int32()),
            "counts": pa.array([total[0, 0].sum(axis=0).tolist()], pa.list_(pa.float64())), "left": pa.array([left[0].tolist()], pa.list_(pa.float64())),
        })

    return best


def _dealt(layout: Layout, tops: list[Top], training: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every block's rows by tree and subtree: with label and count for training, else with their places in the block."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["tree", "node", "block", "at", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for block, bins, labels in _read(layout, batches):
            body = np.column_stack([bins, np.array(labels.as_py()).astype(np.uint8)]) if training else bins
            for tree, top in enumerate(tops):
                if training:
                    count = _counts(layout, tree, block, len(bins))
                    drawn = np.flatnonzero(count)
                    for node, rows in top.dealt(bins[drawn], (SUBTREE,)):
                        out.append((tree, node, block, None, np.column_stack([body[drawn[rows]], count[drawn[rows]]]).tobytes()))
                        size += len(out[-1][-1])
                else:
                    for node, rows in top.dealt(bins, (SUBTREE, LEAF)):
                        out.append((tree, node, block, rows.astype(np.uint16).tobytes(), b"" if top.state[node] == LEAF else body[rows].tobytes()))
                        size += len(out[-1][-1])
                if size >= BATCH_BYTES:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)

    return deal


def _subtree(layout: Layout, tops: list[Top]) -> Callable[[tuple, pa.Table], pa.Table]:
    def grow(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        rows = np.frombuffer(b"".join(table["data"].to_pylist()), np.uint8).reshape(-1, layout.columns + 2)
        nodes = _grown(layout, tree, tops[tree].number[node], np.ascontiguousarray(rows[:, :-2]), rows[:, -2].astype(int), rows[:, -1].astype(float))
        return pa.table({
            "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "nodes": pa.array([len(nodes[0])], pa.int64()),
            "body": pa.array([b"".join(a.tobytes() for a in nodes)], pa.binary()),
        })

    return grow


def _unpacked(layout: Layout, body: bytes) -> tuple[np.ndarray, ...]:
    nodes = len(body) // (6 + 4 * layout.classes)
    below, column, split = np.frombuffer(body, np.int32, nodes), np.frombuffer(body, np.uint8, nodes, 4 * nodes), np.frombuffer(body, np.uint8, nodes, 5 * nodes)
    return below, column, split, np.frombuffer(body, np.uint8, offset=6 * nodes).view(np.uint32).reshape(nodes, layout.classes)


def _voted(layout: Layout, tops: list[Top]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counts of the leaf that each row comes to; a subtree precedes the rows dealt to it, marked by block -1."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subtree: tuple[np.ndarray, ...] = ()
        for batch in batches:
            for tree, node, block, at, data in zip(*batch.columns, strict=True):
                if block.as_py() == -1:
                    subtree = _unpacked(layout, data.as_py())
                    continue
                top, n = tops[tree.as_py()], node.as_py()
                if top.state[n] == LEAF:
                    counts = np.tile(top.counts[n].astype(np.uint32), (len(at.as_py()) // 2, 1))
                else:
                    below, column, split, leaves = subtree
                    counts = leaves[_reached(below, column, split, np.frombuffer(data.as_py(), np.uint8).reshape(-1, layout.columns))]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block.as_py()], pa.int64()), "tree": pa.array([tree.as_py()], pa.int32()),
                    "at": pa.array([at.as_py()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
                })

    return vote


def _summed(layout: Layout) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The class with most votes in all trees, a tree's vote being the shares of classes in the leaf."""
    def most(votes: pa.Table, blocks: pa.Table) -> pa.Table:
        labels = blocks["labels"].combine_chunks().flatten()
        total = np.zeros((len(labels), layout.classes))
        for i in np.argsort(votes["tree"].to_numpy(), kind="stable").tolist():
            counts = np.frombuffer(votes["counts"][i].as_py(), np.uint32).reshape(-1, layout.classes).astype(float)
            total[np.frombuffer(votes["at"][i].as_py(), np.uint16)] += counts / counts.sum(axis=1, keepdims=True)
        return pa.table({"label": labels, "prediction": pa.array(total.argmax(axis=1).astype(float), pa.float64())})

    return most


class ForestModel:
    """A grown forest: tops on the driver, subtrees in a written table of (tree, node, nodes, body)."""

    def __init__(self, layout: Layout, columns: list[str], cuts: list[np.ndarray], tops: list[Top], subtrees: DataFrame, parts: int):
        self.layout, self.columns, self.cuts, self.tops, self.subtrees, self.parts = layout, columns, cuts, tops, subtrees, parts

    def transform(self, df: DataFrame) -> DataFrame:
        """(label, prediction) of every row. A missing number goes to the right of every split."""
        blocks = cut_lineage(_numbers(df, self.columns).mapInArrow(_blocks(self.cuts), BLOCKS), "blocks")
        dealt = blocks.mapInArrow(_dealt(self.layout, self.tops, False), DEALT)
        first = self.subtrees.select("tree", "node", F.lit(-1).cast("long").alias("block"), F.lit(None).cast("binary").alias("at"), F.col("body").alias("data"))
        lots = first.unionByName(dealt).repartition(self.parts, "tree", "node").sortWithinPartitions("tree", "node", "block")
        votes = lots.mapInArrow(_voted(self.layout, self.tops), "block bigint, tree int, at binary, counts binary")
        return votes.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_summed(self.layout), "label double, prediction double")


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(quoted)], F.col("label").cast("double").alias("label"))


def grow(train: DataFrame, columns: list[str], trees: int, depth: int, least: int = 1, seed: int = 42, bins: int = 32) -> ForestModel:
    """A forest over ``columns`` and the classes 0, 1, ... in ``label``; ``least`` sampled rows on each side of a split."""
    if not 2 <= bins <= 256 or len(columns) > 256 or not 0 <= depth <= 30:
        raise ValueError("a forest takes 2 to 256 bins, up to 256 columns and a depth of 0 to 30")
    rows = _numbers(train, columns)
    names = rows.columns[:-1]
    faulty = F.lit(False)
    for c in names:
        faulty = faulty | F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    label = F.col("label")
    wrong = label.isNull() | ~label.between(0, 99) | (label != F.floor(label))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), F.count_if(faulty).alias("faulty"), F.count_if(wrong).alias("wrong")).first()
    if not found.n or found.faulty or found.wrong:
        raise ValueError(f"{found.n} rows to learn from, {found.faulty} with a null, NaN or infinite number, {found.wrong} with a label that is no class from 0 to 99")
    cuts = thresholds(rows, names, bins)
    chosen = len(columns) if trees == 1 else math.ceil(math.sqrt(len(columns)))
    layout = Layout(seed % (1 << 63), trees, len(columns), max(2, *(len(c) + 1 for c in cuts)), int(found.top) + 1, chosen, least, depth)
    blocks = cut_lineage(rows.mapInArrow(_blocks(cuts), BLOCKS), "blocks")
    tops = _tops(layout, blocks, found.n)
    number = sum(top.state.count(SUBTREE) for top in tops)
    parts = max(1, min(number, 4 * train.sparkSession.sparkContext.defaultParallelism), number // 8)
    dealt = blocks.mapInArrow(_dealt(layout, tops, True), DEALT).repartition(parts, "tree", "node")
    subtrees = cut_lineage(dealt.groupBy("tree", "node").applyInArrow(_subtree(layout, tops), "tree int, node int, nodes bigint, body binary"), "subtrees")
    if any(len(top.state) > 1 for top in tops):
        leaves = defaultdict(set)
        for r in subtrees.filter("nodes = 1").select("tree", "node").collect():
            leaves[r.tree].add(r.node)
        for tree, top in enumerate(tops):
            top.prune(leaves[tree])
    return ForestModel(layout, columns, cuts, tops, subtrees, parts)


def _tops(layout: Layout, blocks: DataFrame, rows: int) -> list[Top]:
    """All trees' tops, a level at a time; one small row per open node reaches the driver."""
    tops = [Top(SUBTREE if rows <= SUBTREE_ROWS else OPEN) for _ in range(layout.trees)]
    while any(OPEN in top.state for top in tops):
        added = blocks.mapInArrow(_levelled(layout, tops), "tree int, node int, data binary")
        best = added.groupBy("tree", "node").applyInArrow(_split(layout, tops), "tree int, node int, column int, split int, counts array<double>, left array<double>")
        for r in best.collect():
            tops[r.tree].part(layout, r.node, r.column, r.split, np.array(r.counts), np.array(r.left))
    return tops
