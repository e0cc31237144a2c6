"""A random forest fitted and kept in parts (ML-04, ML-06, ML-12, ML-14).

Spark's estimator grows all trees of a forest level by level from the driver: every pass over the
rows ends at as many nodes as its histograms may hold, and the nodes of all trees pass through the
driver.  Here the rows are binned once (see ``histograms``) and the trees are dealt to tasks, which grow
them whole (see ``growth``); the nodes go from the tasks to the shared folder.  A forest is several
parts of fewer trees, each a saved model of Spark's own.  Scoring averages over all trees: the
rows are binned the same way and a task walks them down as many parts at a time as hold
``SCORED`` nodes; importances average over all trees, as in Spark's model.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from isotherm.llm.common import ship
from isotherm.operators import growth
from isotherm.operators import histograms as hg
from isotherm.session import scratch_path
from isotherm.sources import commits

#: Nodes of a part, which Spark's loader holds in the driver at once (0.4 kB each); a part has one tree at least.
NODES = 100_000
#: Nodes a task holds at once while it scores (16 bytes each), and rows it walks down before it takes the next nodes.
SCORED, SCORED_ROWS = 1_000_000, 262_144
#: MB of split histograms a task holds at most; of its own, ``CELLS`` sums a slot are far below.
HISTOGRAM_MB = 128
CELLS = 65_536
#: Nodes that leave a task at once.
BATCH = 50_000
#: Tasks for each core that grow trees; each has all rows, if they are no more than ``LOCAL_ROWS`` (a task holds about 150 bytes each).
TASKS, LOCAL_ROWS = 2, 4_000_000
#: Bytes of a row group while a task's writers for several parts are open.
ROW_GROUP = 8 * 1024 * 1024

_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])
#: The nodes of Spark's saved forests.
NODE_SCHEMA = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
               "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, "
               "leftCategoriesOrThreshold: array<double>, numCategories: int>>")


@dataclass(frozen=True)
class Part:
    path: str
    trees: int
    nodes: int


class Forest:
    """Fitted preprocessing and the parts of the forest; scores like a pipeline model."""

    def __init__(self, before: PipelineModel, parts: Sequence[Part], importances: np.ndarray, layout: hg.Layout, depth: int):
        self.parts, self.before, self.featureImportances = list(parts), before, DenseVector(importances)
        self.layout, self.depth, self.stages = layout, depth, [*before.stages, self]
        self._sent: dict = {}

    def passes(self, nodes: int = SCORED) -> list[list[Part]]:
        """Parts that are loaded together: no more than ``nodes`` nodes, one part at least."""
        out: list[list[Part]] = []
        for p in self.parts:
            if out and sum(q.nodes for q in out[-1]) + p.nodes <= nodes:
                out[-1].append(p)
            else:
                out.append([p])
        return out

    def _walks(self, spark: SparkSession, together: list[Part]):
        """The trees of some parts, sent to the executors: a file there, loaded by a task while it needs it."""
        key = tuple(p.path for p in together)
        if key not in self._sent:
            trees = _load(spark, sorted(set(key)), self.layout)
            self._sent[key] = spark.sparkContext.broadcast([t for path in key for t in trees[path.rstrip("/").rsplit("/", 1)[-1]]])
        return self._sent[key]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the preprocessing's columns and ``prediction``."""
        spark, layout, depth, total = df.sparkSession, self.layout, self.depth, sum(p.trees for p in self.parts)
        ship(spark)
        sent = [self._walks(spark, together) for together in self.passes()]

        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held: list[np.ndarray] = []

            def scored() -> Iterator[pa.Array]:
                codes, ends = np.concatenate(held), np.cumsum([len(h) for h in held])
                out = np.zeros(len(codes))
                for piece in sent:
                    trees = piece.value
                    piece.__dict__.pop("_value", None)  # the next piece takes its place in memory
                    for i in range(0, len(codes), hg.CHUNK):
                        for walk, value in trees:
                            out[i:i + hg.CHUNK] += value[growth.descend(walk, codes[i:i + hg.CHUNK], depth)]
                for part in np.split(out / total, ends[:-1]):
                    yield pa.array(part)
                held.clear()

            for x in batches:
                held.append(layout.encode(hg._matrix(x, layout.width)))
                if sum(len(h) for h in held) >= SCORED_ROWS:
                    yield from scored()
            if held:
                yield from scored()

        # not deterministic by name only: so that Spark does not run it once more for a filter on the scores
        udf = F.arrow_udf(score, "double").asNondeterministic()
        return self.before.transform(df).withColumn("prediction", udf(vector_to_array("features")))


def _load(spark: SparkSession, paths: Sequence[str], layout: hg.Layout) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
    """Saved trees as arrays, by the last name of their part's path; tasks pack the nodes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, left, slot = (b.column(c).to_numpy() for c in ("id", "left", "slot"))
            threshold, value = (b.column(c).to_numpy(zero_copy_only=False) for c in ("threshold", "value"))
            walk = growth.walk_of(layout, ids, left, slot, threshold)
            tree, path = b.column("tree").to_numpy(), b.column("path").to_pylist()
            starts = [i for i in range(len(b)) if not i or tree[i] != tree[i - 1] or ids[i] != ids[i - 1] + 1 or path[i] != path[i - 1]]
            for i, j in zip(starts, [*starts[1:], len(b)], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([path[i]]), pa.array([tree[i]], pa.int32()), pa.array([ids[i]], pa.int32()),
                                                  pa.array([walk[i:j].tobytes()], pa.binary()), pa.array([value[i:j].tobytes()], pa.binary())],
                                                 names=["path", "tree", "first", "walk", "value"])

    node, saved = F.col("nodeData"), spark.read.schema(NODE_SCHEMA).parquet(*[f"{p}/data" for p in paths])
    runs = saved.select(F.element_at(F.split("_metadata.file_path", "/"), -3).alias("path"), F.col("treeID").alias("tree"), node.id.alias("id"),
                        node.leftChild.alias("left"), node.split.featureIndex.alias("slot"),
                        F.get(node.split.leftCategoriesOrThreshold, 0).alias("threshold"), node.prediction.alias("value"))
    found: dict = {}
    for r in runs.mapInArrow(pack, "path string, tree int, first int, walk binary, value binary").collect():
        found.setdefault((r["path"], r["tree"]), []).append((r["first"], r["walk"], r["value"]))
    out: dict = {}
    for (path, _), pieces in sorted(found.items()):
        pieces.sort(key=lambda x: x[0])
        out.setdefault(path, []).append((np.frombuffer(b"".join(x[1] for x in pieces), growth.WALK), np.frombuffer(b"".join(x[2] for x in pieces))))
    return out


def trees_in_part(rows: int, depth: int, min_leaf: int, nodes: int = NODES) -> int:
    """Trees whose nodes are surely no more than ``nodes``: a tree has fewer than two nodes a leaf, no more leaves than
    its depth allows and no leaf of fewer than ``min_leaf`` rows."""
    leaves = max(1, min(2 ** depth, rows // max(1, min_leaf)))
    return max(1, nodes // (2 * leaves))


def features_of_a_node(strategy: str, width: int, trees: int) -> int:
    """Slots a node may split on, by Spark's names."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(max(1, width))))}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit() and int(strategy) > 0:
        return min(width, int(strategy))
    if not 0 < float(strategy) <= 1:
        raise ValueError(f"share of the features: {strategy}")
    return math.ceil(float(strategy) * width)


def _nodes(keys: dict[str, int], grown: growth.Nodes, start: float) -> Iterator[pa.RecordBatch]:
    """Nodes as Spark saves them, behind the columns ``keys``; the labels were taken relative to ``start``."""
    inner = grown.left >= 0
    mean = grown.s / grown.n
    stats = np.column_stack([grown.n, grown.s + grown.n * start, grown.q + 2 * start * grown.s + grown.n * start ** 2])
    for i in range(0, len(inner), BATCH):
        of = slice(i, i + BATCH)
        here, m = inner[of], len(inner[of])
        split = pa.StructArray.from_arrays(
            [pa.array(grown.slot[of], pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(here)), pa.int32()), pa.array(grown.threshold[of][here])),
             pa.array(np.full(m, -1), pa.int32())], fields=list(_SPLIT))
        node = pa.StructArray.from_arrays(
            [pa.array(np.arange(i, i + m), pa.int32()), pa.array(start + mean[of]), pa.array(np.maximum(grown.q[of] / grown.n[of] - mean[of] ** 2, 0.0)),
             pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * m + 1, 3), pa.int32()), pa.array(stats[of].ravel())),
             pa.array(grown.n[of].astype(np.int64)), pa.array(grown.gain[of]), pa.array(grown.left[of], pa.int32()),
             pa.array(np.where(here, grown.left[of] + 1, -1), pa.int32()), split], fields=list(_NODE))
        yield pa.RecordBatch.from_arrays([*[pa.array(np.full(m, v), pa.int32()) for v in keys.values()], node], names=[*keys, "nodeData"])


def _in_order(blocks: Sequence[pa.RecordBatch]) -> pa.Table:
    """The blocks in an order that does not depend on the shuffle's."""
    table = pa.Table.from_batches(blocks)
    return table.sort_by([("draw", "ascending"), ("residual", "ascending")])


def _chunks(table: pa.Table, layout: hg.Layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for bins, draw, residual in hg._chunks(table.to_batches(max_chunksize=1024), layout.size):
        yield bins, residual, draw


@dataclass(frozen=True)
class _Plan:
    """What a forest's trees are grown by: the binned rows (their labels relative to ``start``) and the trees of every part."""
    blocks: DataFrame
    layout: hg.Layout
    start: float
    firsts: list[int]
    depth: int
    min_leaf: int
    n_allowed: int
    row_share: float
    seed: int

    def part_of(self) -> list[tuple[int, int]]:
        """Part and number in it of every tree."""
        return [(i, k - a) for i, (a, b) in enumerate(zip(self.firsts, self.firsts[1:], strict=False)) for k in range(a, b)]


def fit_forest(vectors: DataFrame, target: str, before: PipelineModel, trees: int = 100, depth: int = 18, min_leaf: int = 5,
               feature_share: str = "auto", row_share: float = 1.0, seed: int = 42, nodes: int = NODES) -> Forest:
    """Fit ``trees`` trees on ``vectors`` (``features`` and ``target``) and save them in parts."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(target).isNotNull()).select("features", F.col(target).cast("double").alias("__y"))
    start = rows.agg(F.avg("__y")).first()[0]
    if start is None:
        raise ValueError("no training row has a label")
    home = scratch_path(spark, f"forest_{uuid.uuid4().hex}")
    layout = hg.find_layout(rows, seed)
    hg.to_blocks(rows, True, layout, start, seed).select("bins", "draw", "residual").write.parquet(f"{home}/blocks")
    blocks = spark.read.schema("bins binary, draw binary, residual binary").parquet(f"{home}/blocks")
    n_parts = math.ceil(trees / trees_in_part(layout.rows, depth, min_leaf, nodes))
    firsts = [trees * i // n_parts for i in range(n_parts + 1)]
    plan = _Plan(blocks, layout, start, firsts, depth, min_leaf, features_of_a_node(feature_share, layout.width, trees), row_share, seed)
    if layout.rows <= LOCAL_ROWS:
        _write_parts(_whole_trees(plan), f"{home}/nodes", n_parts)
    else:
        _write_split_trees(plan, home)
    commits.remove(spark, f"{home}/blocks")
    split = F.col("nodeData.split.featureIndex")
    seen = (spark.read.schema(f"{NODE_SCHEMA}, part int").parquet(f"{home}/nodes").groupBy("part", "treeID", split.alias("slot"))
            .agg(F.sum(F.col("nodeData.gain") * F.col("nodeData.rawCount")).alias("gain"), F.count(F.lit(1)).alias("nodes")).collect())
    sizes = [b - a for a, b in zip(firsts, firsts[1:], strict=False)]
    gains, n_nodes = np.zeros((n_parts, max(sizes), layout.width)), np.zeros(n_parts, int)
    for r in seen:
        n_nodes[r["part"]] += r["nodes"]
        if r["slot"] >= 0:
            gains[r["part"], r["treeID"], r["slot"]] = r["gain"]
    each = gains.sum(axis=2, keepdims=True)
    importances = np.divide(gains, each, out=np.zeros_like(gains), where=each > 0).sum(axis=(0, 1))
    importances /= importances.sum() or 1.0
    spec = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
                                 featureSubsetStrategy=feature_share, subsamplingRate=row_share, seed=seed, maxMemoryInMB=HISTOGRAM_MB)
    _as_models(spark, spec, layout.width, home, sizes)
    parts = [Part(f"{home}/part-{i:05d}", size, int(n)) for i, (size, n) in enumerate(zip(sizes, n_nodes, strict=True))]
    return Forest(before, parts, importances, layout, depth)


def _whole_trees(plan: _Plan) -> DataFrame:
    """Nodes of all trees: every task has all rows and grows its share of the parts."""
    spark, n_parts, of_tree = plan.blocks.sparkSession, len(plan.firsts) - 1, plan.part_of()
    tasks = min(n_parts, TASKS * spark.sparkContext.defaultParallelism)
    layout, start, firsts, depth, min_leaf, n_allowed, share, seed = (getattr(plan, f.name) for f in fields(plan)[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [b for b in batches if len(b)]
        if not mine:
            return
        task, = {v for b in mine for v in b.column("task").unique().to_pylist()}
        table = _in_order(mine)
        mine.clear()
        rows = growth.rows_of(layout, lambda: _chunks(table, layout))
        del table
        pa.default_memory_pool().release_unused()
        for tree in range(firsts[n_parts * task // tasks], firsts[n_parts * (task + 1) // tasks]):
            w = growth.weights(rows.draw, share, growth.tree_key(seed, tree))
            grown = growth.grow(rows, w, layout, np.random.default_rng([seed, tree]), depth, min_leaf, n_allowed, CELLS)
            part, number = of_tree[tree]
            yield from _nodes({"part": part, "treeID": number}, grown, start)

    dealt = plan.blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "task")
    return dealt.mapInArrow(run, f"part int, {NODE_SCHEMA}")


class _Top:
    """The first nodes of a tree while all tasks grow them: numbered in order of the levels, children next to each other."""

    def __init__(self):
        self.left, self.slot, self.threshold, self.gain = [-1], [-1], [0.0], [-1.0]
        self.stats, self.level = [None], [0]

    def walk(self, layout: hg.Layout) -> np.ndarray:
        return growth.walk_of(layout, np.arange(len(self.left)), *map(np.array, (self.left, self.slot, self.threshold)))

    def split(self, node: int, r) -> list[tuple[int, float]]:
        """Enter a split; the children and their drawn rows."""
        self.left[node], self.slot[node], self.threshold[node], self.gain[node] = len(self.left), r["slot"], r["threshold"], r["gain"]
        self.stats[node] = r["n"], r["s"], r["q"]
        for more, value in ((self.left, -1), (self.slot, -1), (self.threshold, 0.0), (self.gain, -1.0), (self.stats, None), (self.level, self.level[node] + 1)):
            more += [value, value]
        return [(self.left[node], r["left_n"]), (self.left[node] + 1, r["n"] - r["left_n"])]


def _grow_tops(plan: _Plan, rows_left: int) -> list[_Top]:
    """The trees down to nodes of at most ``rows_left`` drawn rows, all of a level's nodes at once: tasks add up their rows
    by node and candidate range, the sums are merged by node and the best split comes back."""
    layout, start, firsts, depth, min_leaf, n_allowed, share, seed = (getattr(plan, f.name) for f in fields(plan)[1:])
    tops = [_Top() for _ in range(firsts[-1])]
    pending = [(tree, 0) for tree in range(firsts[-1])]
    cells = len(layout.flags) + sum(hg.COARSE + 1 for _ in layout.ranged)
    at_once = max(1, HISTOGRAM_MB * 2 ** 20 // (2 * 8 * (cells + 2)))

    def candidates(tree: int) -> growth.Candidates:
        return growth.Candidates(layout, np.random.default_rng([seed, tree]))

    def level(nodes: list[tuple[int, int]]) -> DataFrame:
        walks = {tree: (tops[tree].walk(layout), max(tops[tree].level)) for tree, _ in nodes}
        of_tree = {tree: np.array([k for t, k in nodes if t == tree]) for tree in walks}

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ways = {tree: candidates(tree) for tree in walks}
            total = {tree: np.zeros((3, len(k))) for tree, k in of_tree.items()}
            sums = {tree: [np.zeros((2, len(k), r)) for r in [*ways[tree].ranges, len(layout.flags)]] for tree, k in of_tree.items()}
            for codes, draw, y in hg._chunks(batches, layout.size):
                rows = growth.rows_of(layout, lambda: iter([(codes, y, draw)]))  # noqa: B023
                for tree, (walk, steps) in walks.items():
                    w = growth.weights(draw, share, growth.tree_key(seed, tree))
                    node = growth.descend(walk, codes, steps)
                    place = np.full(len(walk), -1)
                    place[of_tree[tree]] = np.arange(len(of_tree[tree]))
                    here = np.flatnonzero((w > 0) & (place[node] >= 0))
                    node, w, label = place[node[here]], w[here], y[here]
                    for j, x in enumerate((w, w * label, w * label * label)):
                        total[tree][j] += np.bincount(node, x, total[tree].shape[1])
                    at = np.array([g[b[here]] for g, b in zip(ways[tree].groups, rows.bins, strict=True)]).reshape(-1, len(here))
                    for to, found in zip(sums[tree], ways[tree].sums(at, rows.sets[:, here], node, len(of_tree[tree]), w, w * label), strict=True):
                        to += np.array(found)
            part = TaskContext.get().partitionId()
            for tree, k in of_tree.items():
                found = [np.concatenate([total[tree][:, i], *[x[:, i].ravel() for x in sums[tree]]]).tobytes() for i in range(len(k))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), tree), pa.int32()), pa.array(k, pa.int32()),
                                                  pa.array(np.full(len(k), part), pa.int32()), pa.array(found, pa.binary())], names=["tree", "node", "part", "sums"])

        def merge(key: tuple, parts: pa.Table) -> pa.Table:
            tree, node = (k.as_py() for k in key)
            flat = np.sum([np.frombuffer(v.as_buffer()) for v in parts.sort_by("part").column("sums")], axis=0)
            (n, s, q), ways = flat[:3], candidates(tree)
            widths = [*ways.ranges, len(layout.flags)]
            each = np.split(flat[3:], np.cumsum([2 * r for r in widths])[:-1])
            best = growth.Chosen(np.array([n]), np.array([s]))
            pairs = [tuple(x.reshape(2, 1, r)) for x, r in zip(each, widths, strict=True)]
            allowed = growth.draw_features(np.random.default_rng([seed, tree, 2, node]), 1, layout.width, n_allowed)
            ways.choose(best, iter(pairs), min_leaf, allowed)
            row = {"tree": tree, "node": node, "slot": None, "threshold": None, "gain": None, "n": n, "s": s, "q": q, "left_n": None}
            if best.wins(np.array([q]))[0]:
                of, at = int(best.of[0]), int(best.at[0])
                slot, threshold = ways.split(of, at)
                below = n - pairs[-1][0][0, of - len(ways.ranges)] if of >= len(ways.ranges) else pairs[of][0][0, :at + 1].sum()
                row |= {"slot": slot, "threshold": float(threshold), "gain": float(best.gain()[0]), "left_n": float(below)}
            return pa.Table.from_pylist([row], schema=pa.schema([(c, pa.int32() if c in ("tree", "node", "slot") else pa.float64()) for c in row]))

        return (plan.blocks.mapInArrow(add_up, "tree int, node int, part int, sums binary").groupBy("tree", "node")
                .applyInArrow(merge, "tree int, node int, slot int, threshold double, gain double, n double, s double, q double, left_n double"))

    while pending:
        found = [r for i in range(0, len(pending), at_once) for r in level(pending[i:i + at_once]).collect()]
        pending = []
        for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
            if r["slot"] is not None:
                top = tops[r["tree"]]
                pending += [(r["tree"], k) for k, n in top.split(r["node"], r) if n > rows_left and top.level[k] < depth]
    return tops


def _write_split_trees(plan: _Plan, home: str) -> None:
    """Trees of more rows than a task may hold: all tasks grow their first nodes, then the rows of every node so reached go to one task,
    which grows the rest; some trees at a time."""
    spark = plan.blocks.sparkSession
    layout, start, firsts, depth, min_leaf, n_allowed, share, seed = (getattr(plan, f.name) for f in fields(plan)[1:])
    tops, of_tree = _grow_tops(plan, LOCAL_ROWS), plan.part_of()
    leaves = [[k for k, x in enumerate(top.left) if x < 0] for top in tops]
    tasks = TASKS * spark.sparkContext.defaultParallelism
    batch: list[int] = []
    for tree in range(len(tops)):
        batch.append(tree)
        if tree + 1 < len(tops) and sum(len(leaves[t]) for t in batch) + len(leaves[tree + 1]) <= tasks:
            continue
        walks = {t: (tops[t].walk(layout), max(tops[t].level)) for t in batch}
        first, levels = {}, {}
        for t in batch:
            first[t] = len(levels)
            levels |= {first[t] + i: (t, k, tops[t].level[k]) for i, k in enumerate(leaves[t])}

        def route(batches: Iterator[pa.RecordBatch], walks=walks, first=first) -> Iterator[pa.RecordBatch]:
            for codes, draw, y in hg._chunks(batches, layout.size):
                for t, (walk, steps) in walks.items():
                    w, node = growth.weights(draw, share, growth.tree_key(seed, t)).astype(np.uint8), growth.descend(walk, codes, steps)
                    for i, k in enumerate(leaves[t]):
                        here = np.flatnonzero((w > 0) & (node == k))
                        if len(here):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([first[t] + i], pa.int32()), *[pa.array([x[here].tobytes()], pa.binary()) for x in (codes, draw, y, w)]],
                                names=["task", "bins", "draw", "residual", "w"])

        def run(batches: Iterator[pa.RecordBatch], levels=levels) -> Iterator[pa.RecordBatch]:
            mine = [b for b in batches if len(b)]
            if not mine:
                return
            task, = {v for b in mine for v in b.column("task").unique().to_pylist()}
            tree, node, level = levels[task]
            table = _in_order(mine)
            mine.clear()
            rows = growth.rows_of(layout, lambda: _chunks(table, layout))
            w = np.concatenate([hg._flat(b.column("w"), np.uint8) for b in table.to_batches()]).astype(float)
            del table
            pa.default_memory_pool().release_unused()
            grown = growth.grow(rows, w, layout, np.random.default_rng([seed, tree, node] if node else [seed, tree]), depth - level, min_leaf, n_allowed, CELLS)
            yield from _nodes({"tree": tree, "top": node}, grown, start)

        dealt = plan.blocks.mapInArrow(route, "task int, bins binary, draw binary, residual binary, w binary").repartitionById(len(levels), "task")
        dealt.mapInArrow(run, f"tree int, top int, {NODE_SCHEMA.split(', ', 1)[1]}").write.mode("append").parquet(f"{home}/grown")
        batch = []
    # numbers within the tree: those of the first nodes stay, the others follow them
    grown = spark.read.schema(f"tree int, top int, {NODE_SCHEMA.split(', ', 1)[1]}").parquet(f"{home}/grown")
    size = {(r["tree"], r["top"]): r["n"] for r in grown.groupBy("tree", "top").agg(F.count(F.lit(1)).alias("n")).collect()}
    bases, heads = [], []
    for tree, top in enumerate(tops):
        part, number = of_tree[tree]
        base = len(top.left) - 1
        for k in leaves[tree]:
            bases.append((tree, k, part, number, base))
            base += size[tree, k] - 1
        for k in (k for k, x in enumerate(top.left) if x >= 0):
            one = growth.Nodes(*(np.array([v]) for v in (top.left[k], top.slot[k], top.threshold[k], top.gain[k], *top.stats[k])))
            node, = next(_nodes({}, one, start)).column("nodeData").to_pylist()
            heads.append((part, number, node | {"id": k}))
    node = F.col("nodeData")
    moved = lambda c: F.when(c >= 0, c + F.col("base")).otherwise(c)
    # a row for every first node without children: few
    numbered = grown.join(F.broadcast(spark.createDataFrame(bases, "tree int, top int, part int, treeID int, base int")), ["tree", "top"]).select(
        "part", "treeID", node.withField("id", F.when(node.id == 0, F.col("top")).otherwise(node.id + F.col("base")))
        .withField("leftChild", moved(node.leftChild)).withField("rightChild", moved(node.rightChild)).alias("nodeData"))
    whole = numbered.unionByName(spark.createDataFrame(heads, f"part int, {NODE_SCHEMA}"))
    _write_parts(whole, f"{home}/nodes", len(firsts) - 1)
    commits.remove(spark, f"{home}/grown")


def _write_parts(nodes: DataFrame, path: str, n_parts: int) -> None:
    """Write a folder a part.  A task's rows come part by part: a writer for each, so that they need not be sorted."""
    conf, name = nodes.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(n_parts))
    try:
        nodes.write.option("parquet.block.size", ROW_GROUP).partitionBy("part").parquet(path)
    finally:
        conf.set(name, before)


def _as_models(spark: SparkSession, spec: RandomForestRegressor, width: int, home: str, sizes: Sequence[int]) -> None:
    """Make every folder of nodes a saved model of ``spec``: the metadata are those of a forest of one leaf, saved by Spark."""
    ml, gateway = spark._jvm.org.apache.spark.ml, spark.sparkContext._gateway
    one = gateway.new_array(ml.regression.DecisionTreeRegressionModel, 1)
    estimator = spec._to_java()
    extra = ml.param.ParamMap()
    one[0] = estimator.copyValues(hg.Tree(0).model(spark, width), extra)
    estimator.copyValues(ml.regression.RandomForestRegressionModel(spec.uid, one, width), extra).write().overwrite().save(f"{home}/one")
    meta = json.loads(spark.read.text(f"{home}/one/metadata").first()[0])
    tree, = spark.read.parquet(f"{home}/one/treesMetadata").collect()
    names = list(tree.asDict())
    rows = [(i, k, tree[1], tree[2]) for i, size in enumerate(sizes) for k in range(size)]
    spark.createDataFrame(rows, f"part int, {names[0]} int, {names[1]} string, {names[2]} double").coalesce(1).write.partitionBy("part").parquet(f"{home}/trees")
    for i, size in enumerate(sizes):
        meta["paramMap"]["numTrees"] = meta["numTrees"] = size
        path = f"{home}/part-{i:05d}"
        commits.commit_text(spark, f"{path}/metadata/part-00000", json.dumps(meta) + "\n")
        commits.move(spark, f"{home}/nodes/part={i}", f"{path}/data")
        commits.move(spark, f"{home}/trees/part={i}", f"{path}/treesMetadata")
