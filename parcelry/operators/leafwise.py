"""Histogram gradient boosting whose trees grow leaf by leaf.

Features are binned once, and the binned rows stand in the executors as blocks of arrays, one a partition, beside their gradients.
A tree then needs only sums over bins: how many rows of a leaf fall in each bin of each feature, and what their gradients add up
to. One pass over the blocks counts all the leaves of a round together, a partial sum a block; what reaches the driver is bounded by
leaves times bins and does not grow with the rows. Of two sibling leaves only the smaller one is counted; the other's sums are the
parent's less its own. Of a leaf with few rows (SENT_ROWS) these are sent in place of sums, and it is split further without a pass.

The leaf with the largest gain is split next, until the tree has as many leaves as it may. To know the gains of the leaves still open,
a round counts the children of all those that may yet be split, so that a tree takes no more rounds than it
gets deep rather than one a leaf. The loss is half the squared error, with an L2 term on leaf values. The sums of the next root and the
loss of the rows held out follow from the leaves of the last tree; both are counted anew now and then.

A binary column of an encoded category is a bin of its category, so that wide encodings cost a bin each and no column.
The fitted trees become a GBTRegressionModel, written in that model's own saved form and loaded: prediction, importances,
saving and loading are Spark's.
"""

from __future__ import annotations

import gc
import json
import logging
import math
import pickle
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import closing
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.operators.order_stats import Wanted, order_statistics
from parcelry.session import new_shared_path, use_checkpoints

log = logging.getLogger(__name__)

#: Trees after which the blocks are checkpointed and all sums counted anew, so that lineage stays short and rounding small.
REWRITE = 16
#: Rows of a block at least, unless there is but one, and its bytes at most.
BLOCK_ROWS, BLOCK_BYTES = 25_000, 16 << 20
#: Rows up to which a leaf's rows are sent: with eight features, 256 KB a leaf.
SENT_ROWS = 1 << 14
#: Blocks up to which the driver adds up their partial sums; those of more are added up in tasks first.
PARTIALS = 16
#: Rows from which early stopping is on where it is left to choose.
MANY_ROWS = 10_000


@dataclass(frozen=True)
class LeafwiseOptions:
    """How to boost. max_depth None is unlimited; early_stopping "auto" is on for over MANY_ROWS rows."""

    learning_rate: float = 0.1
    max_iter: int = 100
    max_leaf_nodes: int | None = 31
    max_depth: int | None = None
    min_samples_leaf: int = 20
    l2_regularization: float = 0.0
    max_bins: int = 255
    early_stopping: bool | str = "auto"
    validation_fraction: float = 0.1
    n_iter_no_change: int = 10
    tol: float = 1e-7
    seed: int = 42

    def __post_init__(self):
        if self.max_leaf_nodes is not None and self.max_leaf_nodes < 2:
            raise ValueError("max_leaf_nodes is 2 or more, or None")
        if not 2 <= self.max_bins <= 255:
            raise ValueError("max_bins is 2 to 255")
        if self.l2_regularization < 0 or self.learning_rate <= 0 or self.max_iter < 1:
            raise ValueError("l2_regularization must not be negative, learning_rate and max_iter must be positive")


@dataclass(eq=False)
class Node:
    """A node of a growing tree. sums: rows and gradients of each bin, for a root and its open leaves.

    aside: what Block.aside gives for its rows; own: the rows themselves, where they were sent.
    """

    id: int
    depth: int
    rows: int
    slope: float
    aside: np.ndarray
    parent: Node | None = None
    sums: np.ndarray | None = None
    own: Block | None = None
    gain: float = 0.0
    slot: int = -1
    children: tuple[Node, Node] | None = None
    split: bool = False


@dataclass
class Bins:
    """Bins of all features in one row of slots: those of each number, then one for each category.

    edges[i] are the upper bounds of the bins of number i but the last; sizes[k] is the number of categories of k.
    """

    edges: list[list[float]]
    sizes: list[int]
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.starts = np.cumsum([0, *[len(e) + 1 for e in self.edges], *self.sizes])

    @property
    def features(self) -> int:
        return len(self.edges) + sum(self.sizes)

    def owner(self, slot: int) -> tuple[int, int]:
        """Field and place of a slot in it."""
        of = int(np.searchsorted(self.starts, slot, "right")) - 1
        return of, slot - int(self.starts[of])

    def feature(self, slot: int) -> tuple[int, float]:
        """Place in the feature vector and threshold of the split at a slot; what is not above it goes left."""
        of, place = self.owner(slot)
        numbers = len(self.edges)
        if of < numbers:
            return of, self.edges[of][place]
        return numbers + slot - int(self.starts[numbers]), 0.5

    @property
    def row_bytes(self) -> int:
        """Bytes of a row in a block."""
        return 8 + sum(_width(int(size)).itemsize for size in np.diff(self.starts))


def _width(size: int) -> np.dtype:
    """Narrowest type of the bins of a field; the one after the last is an unknown category's."""
    return np.min_scalar_type(size)


@dataclass
class Block:
    """Binned rows: the bin of each field and the gradient, first of the rows learnt from, then of those held out."""

    fields: list[np.ndarray]
    slope: np.ndarray
    learnt: int

    def take(self, rows: np.ndarray) -> Block:
        """Some of the rows, by their ascending places."""
        return Block([f[rows] for f in self.fields], self.slope[rows], int(np.searchsorted(rows, self.learnt)))

    def sums(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows and gradients of each bin, of those of the rows that are learnt from."""
        rows = rows[: np.searchsorted(rows, self.learnt)]
        slope, n, s = self.slope[rows], [], []
        for own, size in zip(self.fields, sizes):
            at = own[rows]
            # a category that the encoding does not know belongs to no slot
            n.append(np.bincount(at, minlength=size)[:size])
            s.append(np.bincount(at, slope, size)[:size])
        return np.array([np.concatenate(n), np.concatenate(s)]) if n else np.zeros((2, 0))

    def aside(self, rows: np.ndarray) -> np.ndarray:
        """Number, gradients and squared gradients of those of the rows that are held out; gradients of the others."""
        first, slope = np.searchsorted(rows, self.learnt), self.slope[rows]
        rest = slope[first:]
        return np.array([len(rest), rest.sum(), (rest**2).sum(), slope[:first].sum()])

    @staticmethod
    def joined(blocks: Sequence[Block]) -> Block:
        first, rest = [slice(b.learnt) for b in blocks], [slice(b.learnt, None) for b in blocks]
        both = [*zip(blocks, first), *zip(blocks, rest)]
        fields = [np.concatenate([b.fields[i][at] for b, at in both]) for i in range(len(blocks[0].fields))]
        return Block(fields, np.concatenate([b.slope[at] for b, at in both]), sum(b.learnt for b in blocks))


@dataclass(frozen=True)
class Split:
    """A split as the blocks take it: number or category `of`, and the last bin that goes left, or the category that goes right."""

    id: int
    of: int
    place: int
    number: bool
    left: int
    right: int


def _routed(block: Block, splits: Sequence[Split], wanted: set[int]) -> dict[int, np.ndarray]:
    """Ascending places of the rows of the wanted nodes. Splits come after those above them and lead to wanted nodes."""
    parts, needed = {0: np.arange(len(block.slope))}, wanted.union(s.id for s in splits)
    for s in splits:
        rows = parts.pop(s.id)
        at = block.fields[s.of][rows]
        goes_left = at <= s.place if s.number else at != s.place
        if s.left in needed:
            parts[s.left] = rows[goes_left]
        if s.right in needed:
            parts[s.right] = rows[~goes_left]
    return parts


@dataclass
class Counted:
    """What blocks give for some nodes: aside a node, rows and gradients of each slot of a node that has any, rows of nodes sent whole."""

    aside: np.ndarray
    keys: np.ndarray
    sums: np.ndarray
    blocks: dict[int, Block]


def _count(block: Block, splits: Sequence[Split], summed: Sequence[int], sent: Sequence[int], sizes: np.ndarray) -> Counted:
    if not gc.get_freeze_count():
        gc.freeze()  # a worker collects garbage after each task, and looking through all modules takes longer than a pass
    parts = _routed(block, splits, {*summed, *sent})
    aside = np.array([block.aside(parts[i]) for i in (*summed, *sent)])
    whole = np.concatenate([block.sums(parts[i], sizes) for i in summed], axis=1) if summed else np.zeros((2, 0))
    keys = np.flatnonzero(whole[0])
    return Counted(aside, keys, whole[:, keys], {i: block.take(parts[i]) for i in sent})


def _added(a: Counted, b: Counted) -> Counted:
    keys, at = np.unique(np.concatenate((a.keys, b.keys)), return_inverse=True)
    sums = np.concatenate((a.sums, b.sums), axis=1)
    both = np.array([np.bincount(at, x, len(keys)) for x in sums])
    return Counted(a.aside + b.aside, keys, both, {i: Block.joined((a.blocks[i], b.blocks[i])) for i in a.blocks})


def _moved(block: Block, splits: Sequence[Split], steps: dict[int, float]) -> Block:
    """The rows after a tree has added its steps to their scores."""
    slope = block.slope.copy()
    for leaf, rows in _routed(block, splits, set(steps)).items():
        slope[rows] += steps[leaf]
    return replace(block, slope=slope)


def _to_blocks(batches: Iterator[pa.RecordBatch], sizes: Sequence[int], start: float) -> Iterator[pa.RecordBatch]:
    """One block of the rows (b0, ..., y, held_out) of a task, for a score that is the same on all of them."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    held_out = rows.column("held_out").to_numpy()
    order = np.argsort(held_out, kind="stable")
    fields = [rows.column(f"b{i}").to_numpy()[order].astype(_width(size)) for i, size in enumerate(sizes)]
    block = Block(fields, start - rows.column("y").to_numpy()[order], int(len(order) - held_out.sum()))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])


class _Blocks:
    """The binned rows of one model in the executors, and the passes over them."""

    def __init__(self, table: DataFrame, n: int, bins: Bins, start: float):
        self.bins, self.sizes = bins, np.diff(bins.starts)
        self.spark, self.old, self.file = table.sparkSession, None, None
        cores = self.spark.sparkContext.defaultParallelism
        parts = max(1, min(cores, n // BLOCK_ROWS), math.ceil(n * bins.row_bytes / BLOCK_BYTES))
        made = table.repartition(parts).mapInArrow(partial(_to_blocks, sizes=self.sizes.tolist(), start=start), "block binary")
        self.rdd: RDD = made.rdd.map(lambda r: pickle.loads(r.block)).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = parts

    def counted(self, splits: Sequence[Split], summed: Sequence[int], sent: Sequence[int] = ()) -> tuple[dict, dict, dict]:
        """Aside of the nodes, sums of those to sum, rows of those to send, each by node."""
        found = self.rdd.map(partial(_count, splits=splits, summed=summed, sent=sent, sizes=self.sizes))
        partials = found.collect() if self.parts <= PARTIALS else [found.treeReduce(_added)]
        self._settle()
        slots = int(self.bins.starts[-1])
        sums = np.zeros((2, len(summed) * slots))
        for p in partials:
            sums[:, p.keys] += p.sums
        each = {i: sums[:, k * slots : (k + 1) * slots] for k, i in enumerate(summed)}
        rows = {i: Block.joined([p.blocks[i] for p in partials]) for i in sent}
        return dict(zip((*summed, *sent), sum(p.aside for p in partials))), each, rows

    def root(self, learnt: int) -> Node:
        """A root counted from the rows as they are."""
        aside, sums, _ = self.counted([], [0])
        return Node(0, 0, learnt, float(aside[0][3]), aside[0], None, sums[0])

    def move(self, splits: Sequence[Split], steps: dict[int, float], rewrite: bool) -> None:
        """Add a tree's steps. It is done, and the blocks before are given up, in the pass that comes next."""
        self.old, self.rdd = self.rdd, self.rdd.map(partial(_moved, splits=splits, steps=steps))
        self.rdd.persist(StorageLevel.MEMORY_AND_DISK)
        if rewrite:
            self.rdd.checkpoint()

    def _settle(self) -> None:
        if self.old is None:
            return
        self.old.unpersist()
        self.old = None
        file = self.rdd.getCheckpointFile()
        if file:
            if self.file:
                _delete(self.spark, self.file)
            self.file = file

    def close(self) -> None:
        for rdd in (self.old, self.rdd):
            if rdd is not None:
                rdd.unpersist()
        if self.file:
            _delete(self.spark, self.file)


def find_edges(rows: DataFrame, numbers: Sequence[str], max_bins: int) -> list[list[float]]:
    """Bounds between bins: midway between values where a column has no more of them than bins, else at its quantiles."""
    if not numbers:
        return []
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in numbers])
    few = {}
    for c in numbers:
        found = [r[0] for r in values.select(c).where(F.col(c).isNotNull()).distinct().limit(max_bins + 1).collect()]
        if len(found) <= max_bins:
            found = sorted(found)
            few[c] = [(a + b) / 2 for a, b in zip(found, found[1:])]
    many = [c for c in numbers if c not in few]
    if many:
        parts = tuple(i / max_bins for i in range(1, max_bins))
        stats = order_statistics(values, {c: Wanted(F.col(c), parts) for c in many})
        few.update({c: sorted(set(stats.values[c])) for c in many})
    return [few[c] for c in numbers]


def _binned(rows: DataFrame, numbers: Sequence[str], places: Sequence[str], label: str, bins: Bins) -> DataFrame:
    """(b0, b1, ..., y): the bin of each number and the place of each category, an unknown one after the last."""
    known = [F.when((F.col(c) >= 0) & (F.col(c) < size), F.col(c).cast("int")).otherwise(size) for c, size in zip(places, bins.sizes)]
    made = rows.select(
        *[(-F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(numbers)],
        *[place.alias(f"b{len(numbers) + k}") for k, place in enumerate(known)],
        F.col(label).cast("double").alias("y"),
    )
    wide = [i for i, e in enumerate(bins.edges) if e]
    if wide:
        # a bin ends with its upper bound, a bucket begins with its lower: negated values make one the other
        splits = [[-float("inf"), *[-e for e in reversed(bins.edges[i])], float("inf")] for i in wide]
        made = Bucketizer(inputCols=[f"x{i}" for i in wide], outputCols=[f"u{i}" for i in wide], splitsArray=splits).transform(made)
    own = [(F.lit(len(e)) - F.col(f"u{i}").cast("int") if e else F.lit(0)).alias(f"b{i}") for i, e in enumerate(bins.edges)]
    return made.select(*own, *[f"b{len(numbers) + k}" for k in range(len(places))], "y")


def best_split(node: Node, bins: Bins, options: LeafwiseOptions) -> None:
    """Set the node's largest gain and its slot: the first feature and bin of equal ones. No split that may be made leaves the gain at 0."""
    if options.max_depth is not None and node.depth >= options.max_depth:
        return
    rows, slopes = node.sums
    first = len(bins.edges)
    right_rows, right_slopes = rows.copy(), slopes.copy()
    for i in range(first):
        a, b = bins.starts[i], bins.starts[i + 1]
        right_rows[a:b] = node.rows - np.cumsum(rows[a:b])
        right_slopes[a:b] = node.slope - np.cumsum(slopes[a:b])
    left_rows, left_slopes = node.rows - right_rows, node.slope - right_slopes
    ease = options.l2_regularization
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = left_slopes**2 / (left_rows + ease) + right_slopes**2 / (right_rows + ease) - node.slope**2 / (node.rows + ease)
    least = max(options.min_samples_leaf, 1)
    gains[(left_rows < least) | (right_rows < least)] = 0.0
    if len(gains):
        slot = int(np.argmax(gains))
        # gains within rounding of what a node holds are none
        if gains[slot] > 1e-12 * node.slope**2 / (node.rows + ease):
            node.gain, node.slot = float(gains[slot]), slot


class _Grower:
    """Grows the trees of one model on its blocks."""

    def __init__(self, bins: Bins, options: LeafwiseOptions):
        self.bins, self.options = bins, options

    def split_of(self, node: Node) -> Split:
        of, place = self.bins.owner(node.slot)
        return Split(node.id, of, place, of < len(self.bins.edges), *[c.id for c in node.children])

    def open(self, node: Node, next_id: int) -> int:
        """Give a node its children, whose rows and gradients are known from its sums."""
        of, place = self.bins.owner(node.slot)
        a = self.bins.starts[of]
        own = node.sums[:, a : a + place + 1].sum(1) if of < len(self.bins.edges) else (node.rows, node.slope) - node.sums[:, node.slot]
        left = Node(next_id, node.depth + 1, int(own[0]), float(own[1]), np.zeros(4), node)
        right = Node(next_id + 1, node.depth + 1, node.rows - left.rows, node.slope - left.slope, np.zeros(4), node)
        node.children = (left, right)
        return next_id + 2

    def expand(self, blocks: _Blocks, nodes: list[Node]) -> None:
        """Count the children of all the nodes in one pass."""
        summed, sent, above = [], [], {}
        for node in nodes:
            small, large = sorted(node.children, key=lambda n: (n.rows, n.id))
            (sent if small.rows <= SENT_ROWS else summed).append(small)
            if large.rows <= SENT_ROWS:
                sent.append(large)
            while node is not None and node.id not in above:
                above[node.id] = node
                node = node.parent
        splits = [self.split_of(above[i]) for i in sorted(above)]
        aside, sums, rows = blocks.counted(splits, [n.id for n in summed], [n.id for n in sent])
        for node in (*summed, *sent):
            node.aside = aside[node.id]
            node.own = rows.get(node.id)
            node.sums = sums[node.id] if node.own is None else node.own.sums(np.arange(len(node.own.slope)), blocks.sizes)
        for node in nodes:
            small, large = sorted(node.children, key=lambda n: (n.rows, n.id))
            if large.sums is None:
                large.sums, large.aside = node.sums - small.sums, node.aside - small.aside
            self._rate(node)

    def part(self, node: Node, sizes: np.ndarray) -> None:
        """Split a node's own rows."""
        parts = _routed(node.own, [replace(self.split_of(node), id=0)], {c.id for c in node.children})
        for child in node.children:
            child.own, child.aside = node.own.take(parts[child.id]), node.own.aside(parts[child.id])
            child.sums = node.own.sums(parts[child.id], sizes)
        self._rate(node)

    def _rate(self, node: Node) -> None:
        for child in node.children:
            best_split(child, self.bins, self.options)

    def grow(self, blocks: _Blocks, root: Node) -> list[Node]:
        """Split the root and what is below it. Returns the leaves."""
        most = self.options.max_leaf_nodes or 1 << 30
        best_split(root, self.bins, self.options)
        open_, next_id = [root], 1
        while len(open_) < most:
            ready = sorted((n for n in open_ if n.gain > 0), key=lambda n: (-n.gain, n.id))
            if not ready:
                break
            node = ready[0]
            if node.children is None:
                ahead = [node] if node.own else [n for n in ready[: most - len(open_)] if n.children is None and not n.own]
                for n in ahead:
                    next_id = self.open(n, next_id)
                if node.own:
                    self.part(node, blocks.sizes)
                else:
                    self.expand(blocks, ahead)
            node.split, node.own = True, None
            if node is not root:
                node.sums = None
            open_.remove(node)
            open_.extend(node.children)
        return open_

    def value(self, node: Node) -> float:
        return -node.slope / (node.rows + self.options.l2_regularization)

    def step(self, node: Node) -> float:
        """What a leaf adds to the score of its rows."""
        return self.options.learning_rate * self.value(node)

    def after(self, root: Node, leaves: list[Node]) -> Node:
        """The root of the next tree, from the leaves of one that is grown."""
        sums, aside, slope = root.sums.copy(), root.aside.copy(), root.slope
        for leaf in leaves:
            step, (n, s) = self.step(leaf), leaf.aside[:2]
            sums[1] += step * leaf.sums[0]
            slope += step * leaf.rows
            aside += (0.0, step * n, step * (2 * s + step * n), step * leaf.rows)
        return Node(0, 0, root.rows, slope, aside, None, sums)

    def strip(self, root: Node) -> list[Node]:
        """Give up what only growing needed. Returns the nodes that are split, a node after those above it."""
        found = [root]
        for node in found:
            node.sums = node.own = node.parent = None
            if node.split:
                found.extend(node.children)
            else:
                node.children = None
        return [n for n in found if n.split]


def _stalled(losses: list[float], options: LeafwiseOptions) -> bool:
    """Whether none of the last rounds has lowered the loss by over tol against the round before them."""
    n = options.n_iter_no_change
    return len(losses) > n and min(losses[-n:]) >= losses[-n - 1] - options.tol


def fit_leafwise(
    rows: DataFrame, numbers: Sequence[str], places: Sequence[str], sizes: Sequence[int], label: str, options: LeafwiseOptions, **columns: str
) -> GBTRegressionModel:
    """Boosted trees over `numbers`, then over the categories of `places`, columns of 0-based places of `sizes` categories.

    The model reads a feature vector of the numbers followed by a 0/1 element for each category. `columns` are the model's
    featuresCol, labelCol and predictionCol. Binned rows stand in the shared folder while trees are grown.
    """
    spark = rows.sparkSession
    use_checkpoints(spark)
    bins = Bins(find_edges(rows, numbers, options.max_bins), list(sizes))
    path = new_shared_path(spark, "binned")
    held_out = F.rand(options.seed) < F.lit(options.validation_fraction)
    _binned(rows, numbers, places, label, bins).withColumn("held_out", held_out).write.parquet(path)
    made = spark.read.parquet(path)
    n = made.count()
    if not n:
        raise ValueError("No rows with a label; nothing can be fitted")
    stops = options.early_stopping is True or (options.early_stopping == "auto" and n > MANY_ROWS)
    if stops:
        log.info("Early stopping holds %.0f %% of the rows out", 100 * options.validation_fraction)
    else:
        made = made.withColumn("held_out", F.lit(False))
    start, learnt = made.where(~F.col("held_out")).agg(F.avg("y"), F.count("y")).first()
    grower, trees, losses = _Grower(bins, options), [], []
    with closing(_Blocks(made, n, bins, start)) as blocks:
        root = blocks.root(learnt)
        for turn in range(options.max_iter):
            leaves = grower.grow(blocks, root)
            if not root.split:
                break  # no leaf may be split, and none will be later
            rewrite = (turn + 1) % REWRITE == 0 and turn + 1 < options.max_iter
            following, steps = grower.after(root, leaves), {n.id: grower.step(n) for n in leaves}
            blocks.move([grower.split_of(n) for n in grower.strip(root)], steps, rewrite)
            trees.append(root)
            root = blocks.root(learnt) if rewrite else following
            if stops:
                losses.append(root.aside[2] / root.aside[0] / 2 if root.aside[0] else 0.0)
                if _stalled(losses, options):
                    break
    _delete(spark, path)
    return _as_model(spark, start, trees, grower, columns)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _node_rows(tree: int, root: Node | None, grower: _Grower, prediction: float = 0.0) -> list[tuple]:
    """Rows of the saved form of one tree: ids count from the root, children after parents."""
    if root is None:
        return [(tree, (0, prediction, 0.0, [1.0, prediction, 0.0], 1, -1.0, -1, -1, (-1, [], -1)))]
    order, number = [root], {root.id: 0}
    for node in order:
        if node.split:
            for child in node.children:
                number[child.id] = len(order)
                order.append(child)
    out = []
    for node in order:
        stats = [float(node.rows), -node.slope, 0.0]
        if node.split:
            feature, threshold = grower.bins.feature(node.slot)
            left, right = (number[c.id] for c in node.children)
            ends = (node.gain / node.rows, left, right, (feature, [threshold], -1))
        else:
            ends = (-1.0, -1, -1, (-1, [], -1))
        out.append((tree, (number[node.id], grower.value(node), 0.0, stats, node.rows, *ends)))
    return out


_NODE_SCHEMA = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def _as_model(spark: SparkSession, start: float, trees: list[Node], grower: _Grower, columns: dict) -> GBTRegressionModel:
    """The trees as Spark's model: the first is one leaf with the mean, the others weigh the learning rate."""
    options, features = grower.options, grower.bins.features

    def described(kind: str, uid: str, given: dict, **more) -> str:
        whole = {"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps({**whole, "uid": f"{uid}_{uuid.uuid4().hex[:12]}", "paramMap": given, "defaultParamMap": {}, "numFeatures": features, **more})

    tree = {"leafCol": "", "impurity": "variance"}
    given = {**columns, "stepSize": options.learning_rate, "maxIter": options.max_iter, "minInstancesPerNode": max(options.min_samples_leaf, 1), **tree}
    rows = _node_rows(0, None, grower, start)
    for i, root in enumerate(trees, 1):
        rows += _node_rows(i, root, grower)
    each = [(i, described("DecisionTreeRegressionModel", "dtr", tree), options.learning_rate if i else 1.0) for i in range(len(trees) + 1)]
    path = new_shared_path(spark, "trees")
    whole = described("GBTRegressionModel", "leafwise", given, numTrees=len(each))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows, _NODE_SCHEMA).write.parquet(f"{path}/data")
    model = GBTRegressionModel.load(path)
    _delete(spark, path)
    return model
