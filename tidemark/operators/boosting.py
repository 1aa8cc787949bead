"""Gradient boosting over packed rows: a fit that goes on where it stopped, and gives the model of any number of its trees."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession

from .forest import reached
from .packed import BINS, Block, Packed, packed

_AFRESH = 10  # margins are computed from the packed rows again after so many trees, which bounds their lineage


@dataclass
class Regression:
    """A regression tree's nodes by heap number: the column and last left bin of a split (-1: none), gain, and the mean."""

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    mean: np.ndarray


@dataclass
class Boosted:
    """Boosting for log loss on one table of rows, as Spark's: the first tree fits labels of -1 and 1, each later one the loss's
    gradient with a weight of step; splits are by variance, over all rows and columns.  The table is packed once for fits of all
    depths; a tree depends only on those before, so a fit with fewer trees is the beginning of one with more.
    """

    table: Packed | None = None
    trees: dict[tuple[int, float], list[Regression]] = field(default_factory=dict)
    states: dict[tuple[int, float], RDD] = field(default_factory=dict)
    built: dict[tuple[int, float], list] = field(default_factory=dict)

    def model(self, train: DataFrame, columns: list[str], target: str, trees: int, depth: int, step: float) -> GBTClassificationModel:
        """The model of so many trees; train, columns and target are those of every call.  Its nodes hold no impurity."""
        if self.table is None:
            self.table = packed(train, columns, target)
        kind = (depth, step)
        grown, built = self.trees.setdefault(kind, []), self.built.setdefault(kind, [])
        while len(grown) < trees:
            self._grow(kind)
        spark = SparkSession.active()
        built += [_tree(spark, t, [self.table.cuts[c] for c in columns]) for t in grown[len(built) : trees]]
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        ml = jvm.org.apache.spark.ml
        own, weights = gateway.new_array(ml.regression.DecisionTreeRegressionModel, trees), gateway.new_array(jvm.double, trees)
        for k in range(trees):
            own[k], weights[k] = built[k], step if k else 1.0
        return GBTClassificationModel(ml.classification.GBTClassificationModel(f"boosted_{uuid.uuid4().hex[:12]}", own, weights, len(columns), 2))

    def free(self) -> None:
        for r in self.states.values():
            r.unpersist()
        if self.table:
            self.table.unpersist()

    def _grow(self, kind: tuple[int, float]) -> None:
        depth, step = kind
        grown = self.trees[kind]
        last = self.states.get(kind)
        if last is None or len(grown) % _AFRESH == 0:
            state = self.table.blocks.map(_begun(list(grown), step))
        else:
            state = last.map(_moved(grown[-1], step if len(grown) > 1 else 1.0))
        state.persist(StorageLevel.MEMORY_AND_DISK)
        n = 2 ** (depth + 1) - 1
        tree, active, width = Regression(np.full(n, -1), np.full(n, 255), np.zeros(n), np.zeros(n)), [0], len(self.table.columns)
        for level in range(depth):
            if not active:
                break
            parts = state.mapPartitions(_sums(tree, active, level, width))
            cells = parts.treeReduce(np.add, 2) if state.getNumPartitions() > 256 else np.sum(parts.collect(), axis=0)
            below = []
            for j, node in enumerate(active):
                below += _split(tree, node, cells[:, j])
            active = below
        grown.append(tree)
        self.states[kind] = state
        if last is not None:
            last.unpersist()


def _split(tree: Regression, node: int, cells: np.ndarray) -> list[int]:
    """Puts the node's best split into the tree; its children.  cells: (rows, sum) x column x bin."""
    n, s = cells[0, 0].sum(), cells[1, 0].sum()
    if not n:
        return []
    tree.mean[node] = s / n
    nl, sl = cells[0].cumsum(1)[:, :-1], cells[1].cumsum(1)[:, :-1]
    nr, sr = n - nl, s - sl
    fair = (nl > 0) & (nr > 0)
    gain = np.where(fair, (sl**2 / np.maximum(nl, 1) + sr**2 / np.maximum(nr, 1) - s**2 / n) / n, -1.0)
    k, b = np.unravel_index(gain.argmax(), gain.shape)
    if gain[k, b] <= 1e-15:
        return []
    tree.feature[node], tree.cut[node], tree.gain[node] = k, b, gain[k, b]
    a = 2 * node + 1
    tree.mean[a], tree.mean[a + 1] = sl[k, b] / nl[k, b], sr[k, b] / nr[k, b]
    return [a, a + 1]


def _said(x: np.ndarray, tree: Regression) -> np.ndarray:
    """The mean of each row's leaf; a leaf above the last level passes its mean on to the left."""
    mean = tree.mean.copy()
    for node in range(len(mean) // 2):
        if tree.feature[node] < 0:
            mean[2 * node + 1] = mean[node]
    depth = (len(mean) + 1).bit_length() - 2
    return mean[reached(x, tree.feature, tree.cut, depth)]


def _state(b: Block, margin: np.ndarray | None) -> tuple:
    sign = 2.0 * b.y - 1
    left = sign if margin is None else 4 * sign / (1 + np.exp(2 * sign * margin))
    return b, margin, left


def _begun(grown: list[Regression], step: float):
    def begin(b: Block) -> tuple:
        return _state(b, sum((step if k else 1.0) * _said(b.x, t) for k, t in enumerate(grown)) if grown else None)

    return begin


def _moved(tree: Regression, weight: float):
    def move(state: tuple) -> tuple:
        b, margin, _ = state
        return _state(b, (0.0 if margin is None else margin) + weight * _said(b.x, tree))

    return move


def _sums(tree: Regression, active: list[int], level: int, width: int):
    feature, cut = tree.feature.copy(), tree.cut.copy()
    slots = np.full(2**level, -1)
    slots[np.array(active) - (2**level - 1)] = np.arange(len(active))

    def add(states: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((2, len(active), width, BINS))
        for b, _, left in states:
            slot = slots[reached(b.x, feature, cut, level) - (2**level - 1)]
            keep = None if (slot >= 0).all() else np.flatnonzero(slot >= 0)
            x, r, base = (b.x, left, slot * BINS) if keep is None else (b.x[:, keep], left[keep], slot[keep] * BINS)
            for k in range(width):
                at = base + x[k]
                out[0, :, k] += np.bincount(at, minlength=len(active) * BINS).reshape(-1, BINS)
                out[1, :, k] += np.bincount(at, r, len(active) * BINS).reshape(-1, BINS)
        yield out

    return add


def _tree(spark: SparkSession, tree: Regression, cuts: list[np.ndarray]):
    """The tree as Spark's model of one."""
    ml = spark._jvm.org.apache.spark.ml

    def node(k: int):
        if tree.feature[k] < 0:
            return ml.tree.LeafNode(float(tree.mean[k]), 0.0, None)
        split = ml.tree.ContinuousSplit(int(tree.feature[k]), float(cuts[tree.feature[k]][tree.cut[k]]))
        return ml.tree.InternalNode(float(tree.mean[k]), 0.0, float(tree.gain[k]), node(2 * k + 1), node(2 * k + 2), split, None)

    return ml.regression.DecisionTreeRegressionModel(f"tree_{uuid.uuid4().hex[:12]}", node(0), len(cuts))
