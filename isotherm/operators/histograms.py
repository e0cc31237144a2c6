"""Regression trees on binned rows: the trees of gradient boosting (ML-05, ML-12).

Spark's estimator counts the rows, samples split points and turns the vectors into bins for
every tree it is asked for, which boosting does each round.  Here that happens once, as in the
reference's ``tree_method="hist"``: a slot of the feature vector becomes one byte (its bin; two-valued
slots share a byte, a bit each) and rows travel as blocks of ``BLOCK`` rows in binary columns.  A level
of a tree is one job: every task adds up its rows' residuals by node and bin, the sums are shuffled
by node and merged, and the node's best split comes back, one row a node.  Only that and
the cut points, which tasks place slot by slot, pass through the driver.

As in Spark's trees: variance gain, up to 32 candidate ranges a slot, the share of the features drawn
anew for every node, the share of the rows drawn without replacement for every tree, one row a leaf
at least; a grown tree becomes Spark's own tree model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from isotherm.llm.common import ship

#: Rows in a block, one row of the block table.
BLOCK = 64
#: Rows that are handled at once inside a task.
CHUNK = 65_536
#: Ranges a slot is cut into once; a byte holds them.
FINE = 256
#: Candidate ranges of a slot in one tree, as Spark's maxBins.  A slot of more values is regrouped every tree from another start.
COARSE = 32
#: Training rows (expected) whose values place the cut points; Spark's trees take 10,000.
CUT_ROWS = 40_000

#: Nodes of a level whose sums a task holds at once; more of them take another pass over the rows.
NODES = 256

#: Rows that are worth a part of their own, and rows a part holds at most (about 30 bytes each).
PART_ROWS, PART_MOST = 20_000, 2_000_000

BLOCK_SCHEMA = "fit boolean, rows int, bins binary, draw binary, residual binary, error double"
_SPLIT_SCHEMA = ("node int, slot int, at int, gain double, n double, s double, q double, "
                 "left_n double, left_s double, left_q double")


@dataclass(frozen=True)
class Layout:
    """Where the slots of a feature vector lie in a row's bytes (constant slots have none), and the training rows' number."""
    rows: int
    width: int
    ranged: tuple[int, ...]
    cuts: tuple[np.ndarray, ...]
    flags: tuple[int, ...]
    flag_cuts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.ranged) + math.ceil(len(self.flags) / 8)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """A row's bytes: for a ranged slot the number of cuts below its value, for a flag whether its value exceeds the cut."""
        out = np.empty((len(x), self.size), np.uint8)
        for i, (slot, cuts) in enumerate(zip(self.ranged, self.cuts, strict=True)):
            out[:, i] = np.searchsorted(cuts, x[:, slot], side="left")
        if self.flags:
            out[:, len(self.ranged):] = np.packbits(~(x[:, list(self.flags)] <= self.flag_cuts), axis=1, bitorder="little")
        return out

    def groups(self, rng: np.random.Generator) -> np.ndarray:
        """For one tree, the candidate range of every bin of the ranged slots."""
        out = np.zeros((len(self.ranged), FINE), np.intp)
        for i, cuts in enumerate(self.cuts):
            bins = len(cuts) + 1
            out[i, :bins] = np.arange(bins) if bins <= COARSE else (np.arange(bins) * COARSE + rng.integers(bins)) // bins
        return out


def cut_points(values: np.ndarray, low: float, high: float) -> np.ndarray:
    """Up to ``FINE`` - 1 cuts between neighbouring values that part ``values`` and both bounds evenly."""
    v, n = np.unique(np.append(values[np.isfinite(values)], [low, high]), return_counts=True)
    at = np.arange(len(v) - 1)
    if len(v) > FINE:
        below = np.cumsum(n)
        at = np.unique(np.searchsorted(below, np.arange(1, FINE) * below[-1] / FINE))
        at = at[at < len(v) - 1]
    return np.unique(v[at] / 2 + v[at + 1] / 2)


def find_layout(train: DataFrame, seed: int) -> Layout:
    """Bounds of every slot over all rows; cut points from ``CUT_ROWS`` of them (all, if fewer) and the bounds."""
    m = train.select(Summarizer.metrics("count", "min", "max").summary(F.col("features")).alias("m")).first()["m"]
    low, high, rows = m["min"].toArray(), m["max"].toArray(), m["count"]
    sample = train if rows <= CUT_ROWS else train.sample(CUT_ROWS / rows, seed=seed)
    varied = np.flatnonzero(low < high)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), len(low))
            yield pa.RecordBatch.from_arrays([pa.array(varied, pa.int32()), pa.array([x[:, i].tobytes() for i in varied], pa.binary())],
                                             names=["slot", "v"])

    def place(key: tuple, of: pa.Table) -> pa.Table:
        i = key[0].as_py()
        values = np.concatenate([np.frombuffer(v.as_buffer()) for v in of.column("v")])
        return pa.table({"slot": pa.array([i], pa.int32()), "cuts": pa.array([cut_points(values, low[i], high[i])], pa.list_(pa.float64()))})

    ship(train.sparkSession)
    placed = (sample.select(vector_to_array("features").alias("x")).mapInArrow(turn, "slot int, v binary")
              .groupBy("slot").applyInArrow(place, "slot int, cuts array<double>").collect())
    placed = {r["slot"]: np.array(r["cuts"]) for r in placed}
    ranged, cuts, flags, flag_cuts = [], [], [], []
    for slot in varied.tolist():
        found = placed.get(slot)
        if found is None:  # no row in the sample
            found = cut_points(np.empty(0), low[slot], high[slot])
        if len(found) == 1:
            flags.append(slot)
            flag_cuts.append(found[0])
        else:
            ranged.append(slot)
            cuts.append(found)
    return Layout(rows, len(low), tuple(ranged), tuple(cuts), tuple(flags), np.array(flag_cuts))


def _matrix(arrays: pa.Array, width: int) -> np.ndarray:
    if arrays.null_count:
        raise ValueError("a row has no features")
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(len(arrays), width)


def _flat(column: pa.Array, kind) -> np.ndarray:
    """All blocks of a binary column as one array."""
    if not len(column):
        return np.empty(0, kind)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.empty(0, np.uint8)).view(kind)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The rows of ``values`` as binary blocks that end before the rows ``ends``."""
    width = values.dtype.itemsize * math.prod(values.shape[1:])
    offsets = np.append(0, ends * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def to_blocks(rows: DataFrame, fit: bool, layout: Layout, start: float, seed: int) -> DataFrame:
    """``rows`` (features, __y) of one window as blocks of bins and residuals from the score ``start``."""
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            residual, draw = b.column("y").to_numpy() - start, b.column("draw").to_numpy().astype(np.uint32)
            ends = np.append(np.arange(BLOCK, len(residual), BLOCK), len(residual))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ends), fit)), pa.array(np.diff(ends, prepend=0).astype(np.int32)),
                 _cut(layout.encode(_matrix(b.column("x"), layout.width)), ends), _cut(draw, ends), _cut(residual, ends),
                 pa.array(np.add.reduceat(residual ** 2, np.append(0, ends[:-1])))],
                names=["fit", "rows", "bins", "draw", "residual", "error"])

    return rows.select(vector_to_array("features").alias("x"), F.col("__y").alias("y"),
                       F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("draw")).mapInArrow(block, BLOCK_SCHEMA)


def parts(spark: SparkSession, layout: Layout) -> int:
    """Even parts of the block table: one a core, fewer for few rows, more for very many."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, math.ceil(layout.rows / PART_ROWS)), math.ceil(layout.rows / PART_MOST))


class Tree:
    """A tree by heap number: node i has the children 2i and 2i + 1, the root is 1."""

    def __init__(self, depth: int):
        inner, nodes = 2 ** depth, 2 ** (depth + 1)
        self.depth = depth
        self.split = np.zeros(nodes, bool)
        self.column, self.mask, self.limit = np.zeros(inner, np.intp), np.zeros(inner, np.uint8), np.zeros(inner, np.uint8)
        self.slot, self.threshold, self.gain = np.zeros(inner, int), np.zeros(inner), np.zeros(inner)
        self.stats = np.zeros((nodes, 3))

    @property
    def value(self) -> np.ndarray:
        return np.divide(self.stats[:, 1], self.stats[:, 0], out=np.zeros(len(self.stats)), where=self.stats[:, 0] > 0)

    def take(self, found: dict, layout: Layout) -> None:
        """Enter a node's sums and its best split, if it has one."""
        i = found["node"]
        self.stats[i] = found["n"], found["s"], found["q"]
        if found["slot"] is None:
            return
        left = np.array([found["left_n"], found["left_s"], found["left_q"]])
        self.split[i], self.slot[i], self.gain[i] = True, found["slot"], found["gain"]
        self.stats[2 * i], self.stats[2 * i + 1] = left, self.stats[i] - left
        if found["slot"] in layout.ranged:
            c = layout.ranged.index(found["slot"])
            self.column[i], self.mask[i], self.limit[i], self.threshold[i] = c, 255, found["at"], layout.cuts[c][found["at"]]
        else:
            c = layout.flags.index(found["slot"])
            self.column[i], self.mask[i], self.threshold[i] = len(layout.ranged) + c // 8, 1 << c % 8, layout.flag_cuts[c]

    def nodes_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node every row (a column of ``bins``) reaches within ``levels`` levels."""
        node, row = np.ones(bins.shape[1], np.intp), np.arange(bins.shape[1])
        for level in range(levels):
            down = slice(None) if self.split[2 ** level:2 ** (level + 1)].all() else np.flatnonzero(self.split[node])
            at = node[down]
            node[down] = 2 * at + ((bins[self.column[at], row[down]] & self.mask[at]) > self.limit[at])
        return node

    def model(self, spark: SparkSession, width: int):
        """Spark's tree model (its Java object)."""
        jvm, sc = spark._jvm, spark.sparkContext
        tree, impurity = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceAggregator()
        sums = _py2java(sc, DenseVector(np.column_stack([self.stats, self.stats[:, 0]]).ravel())).toArray()
        value = self.value

        def build(i: int):
            n, s, q = self.stats[i]
            spread = float(max(q / n - (s / n) ** 2, 0.0)) if n else 0.0
            calculator = impurity.getCalculator(sums, 4 * i)
            if not self.split[i]:
                return tree.LeafNode(float(value[i]), spread, calculator)
            split = tree.ContinuousSplit(int(self.slot[i]), float(self.threshold[i]))
            return tree.InternalNode(float(value[i]), spread, float(self.gain[i]), build(2 * i), build(2 * i + 1), split, calculator)

        return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(build(1), width)


def hashed(draw: np.ndarray, key: int) -> np.ndarray:
    """Even numbers of 32 bits from the rows' draws and a tree's key."""
    h = (draw ^ np.uint32(key)) * np.uint32(0x9E3779B1)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
    return h ^ (h >> np.uint32(16))


def drawn(draw: np.ndarray, share: float, key: int) -> np.ndarray:
    """The rows a tree takes: each with probability ``share``, the same in every pass over them."""
    return hashed(draw, key) < share * 2.0 ** 32


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, draws and residuals of up to ``CHUNK`` rows."""
    for b in batches:
        draw, residual = _flat(b.column("draw"), np.uint32), _flat(b.column("residual"), float)
        bins = _flat(b.column("bins"), np.uint8).reshape(len(draw), size)
        for i in range(0, len(draw), CHUNK):
            yield bins[i:i + CHUNK], draw[i:i + CHUNK], residual[i:i + CHUNK]


def _level_sums(layout: Layout, tree: Tree, level: int, first: int, groups: np.ndarray, share: float, key: int):
    """Task of a level: per node from ``first`` on, count, sum and sum of squares of the residuals: of all rows, by range of every ranged
    slot, of the rows above every flag's cut.  Squares choose no split; but for all rows they are taken where no level follows
    that would tell the children's."""
    nodes, ranges, n_ranged = min(2 ** level, NODES), COARSE + 1, len(layout.ranged)
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(float)  # value of a byte x flag

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, nodes + 1))
        ranged = np.zeros((n_ranged, 3, (nodes + 1) * ranges))
        packed = np.zeros((layout.size - n_ranged, 3, (nodes + 1) * 256))
        for bins, draw, residual in _chunks(batches, layout.size):
            if share < 1:
                take = drawn(draw, share, key)
                bins, residual = bins[take], residual[take]
            bins = np.ascontiguousarray(bins.T)
            node = tree.nodes_of(bins, level) - first
            node[(node < 0) | (node > nodes)] = nodes  # its leaf is further up, or another pass has it
            weights = (None, residual, residual * residual)

            def add(to, at, kinds=3 if level == tree.depth - 1 else 2):
                for j, w in enumerate(weights[:kinds]):  # noqa: B023
                    to[j] += np.bincount(at, w, minlength=to.shape[1])
            add(total, node, 3)
            for i in range(n_ranged):
                add(ranged[i], groups[i][bins[i]] + node * ranges)
            for i in range(len(packed)):
                add(packed[i], bins[n_ranged + i] + node * 256)
        here = np.flatnonzero(total[0, :nodes])
        by_range = ranged.reshape(n_ranged, 3, nodes + 1, ranges)
        above = np.concatenate([p.reshape(3, nodes + 1, 256) @ bits for p in packed] or [np.zeros((3, nodes + 1, 0))], axis=2)[:, :, :len(layout.flags)]
        sums = [np.concatenate([total[:, i], by_range[:, :, i].ravel(), above[:, i].ravel()]).tobytes() for i in here]
        yield pa.RecordBatch.from_arrays([pa.array((here + first).astype(np.int32)), pa.array([TaskContext.get().partitionId()] * len(here), pa.int32()),
                                          pa.array(sums, pa.binary())], names=["node", "part", "sums"])
    return run


def best_split(layout: Layout, sums: np.ndarray, groups: np.ndarray, allowed: np.ndarray) -> tuple | None:
    """Slot, highest bin on the left, gain and the left side's three sums of the split of most variance gain; None if no
    split of an ``allowed`` slot gains.  Ties, up to rounding, go to the ranged slots, the smaller slot, the lower cut."""
    ranges, k = COARSE + 1, len(layout.ranged)
    n, s, q = sums[:3]
    by_range = sums[3:3 + k * 3 * ranges].reshape(k, 3, ranges)
    left = np.concatenate([np.cumsum(by_range, axis=2)[:, :, :-1].transpose(1, 0, 2).reshape(3, -1),
                           sums[:3, None] - sums[3 + k * 3 * ranges:].reshape(3, -1)], axis=1)
    slots = np.concatenate([np.repeat(np.array(layout.ranged, int), ranges - 1), np.array(layout.flags, int)])
    ln, ls, _ = left
    valid = (ln >= 1) & (n - ln >= 1) & np.isin(slots, allowed)
    if not valid.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(valid, (ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n) / n, -np.inf)
    if gain.max() <= 1e-12 * q / n:  # rounding, not gain
        return None
    i = int(np.argmax(gain >= gain.max() * (1 - 1e-9)))
    at = 0
    if i < k * (ranges - 1):
        slot, group = divmod(i, ranges - 1)
        at = int(np.flatnonzero(groups[slot][:len(layout.cuts[slot]) + 1] <= group)[-1])
    return int(slots[i]), at, float(gain[i]), *(float(v) for v in left[:, i])


def grow(blocks: DataFrame, layout: Layout, seed: int, depth: int, row_share: float, feature_share: float) -> Tree:
    """One tree on the residuals of the training blocks, a job a level."""
    rng = np.random.default_rng(seed)
    key, groups = int(rng.integers(2 ** 32)), layout.groups(rng)
    tree, n_allowed = Tree(depth), math.ceil(feature_share * layout.width)
    train = blocks.where("fit").select("bins", "draw", "residual")

    def merge(node: tuple, parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("part")  # the order of the sum does not depend on the shuffle's
        sums = np.sum([np.frombuffer(v.as_buffer()) for v in parts.column("sums")], axis=0)
        i = node[0].as_py()
        allowed = np.random.default_rng([seed, i]).permutation(layout.width)[:n_allowed]
        best = best_split(layout, sums, groups, allowed)
        row = (i, *(best[:3] if best else (None, None, None)), *(float(v) for v in sums[:3]), *(best[3:] if best else (None, None, None)))
        types = {"int": pa.int32(), "double": pa.float64()}
        fields = [f.split() for f in _SPLIT_SCHEMA.split(", ")]
        return pa.table({name: pa.array([v], types[kind]) for (name, kind), v in zip(fields, row, strict=True)})

    for level in range(depth):
        for first in range(2 ** level, 2 ** (level + 1), NODES):
            if level and not tree.split[first // 2:(first + NODES) // 2 + 1].any():
                continue
            sums = train.mapInArrow(_level_sums(layout, tree, level, first, groups, row_share, key), "node int, part int, sums binary")
            for found in sums.groupBy("node").applyInArrow(merge, _SPLIT_SCHEMA).collect():
                tree.take(found.asDict(), layout)
        if not tree.split[2 ** level:2 ** (level + 1)].any():
            break
    return tree


def add_tree(blocks: DataFrame, layout: Layout, tree: Tree, step: float) -> DataFrame:
    """The blocks with ``step`` times the tree's values taken off the residuals, and each block's squared error."""
    size, value = layout.size, step * tree.value

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            ends, residual = np.cumsum(b.column("rows").to_numpy()), _flat(b.column("residual"), float).copy()
            bins = _flat(b.column("bins"), np.uint8).reshape(len(residual), size)
            for i in range(0, len(residual), CHUNK):
                residual[i:i + CHUNK] -= value[tree.nodes_of(np.ascontiguousarray(bins[i:i + CHUNK].T), tree.depth)]
            new = {"residual": _cut(residual, ends), "error": pa.array(np.add.reduceat(residual ** 2, np.append(0, ends[:-1])))}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names)

    return blocks.mapInArrow(score, BLOCK_SCHEMA)


def ensemble(spark: SparkSession, trees: Sequence[Tree], step: float, width: int):
    """Spark's boosted-tree model of ``trees``, each at the weight ``step`` (its Java object)."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    java_trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, t in enumerate(trees):
        java_trees[i], weights[i] = t.model(spark, width), step
    return ml.regression.GBTRegressionModel(ml.util.Identifiable.randomUID("gbtr"), java_trees, weights, width)
