"""Random forests over packed rows: one pass for each level of all trees, which counts classes by node, feature and bin."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .packed import BINS, Block, Packed

# weights of bootstrapped rows: Poisson with mean 1, by 16 random bits
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)][:-1]), (np.arange(1 << 16) + 0.5) / (1 << 16), "right").astype(np.float64)


@dataclass
class Tree:
    """Nodes by heap number: the feature and last left bin of a split (-1: none), gain, weight and the class that most rows have."""

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    weight: np.ndarray
    says: np.ndarray

    @staticmethod
    def of(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.full(n, 255), np.zeros(n), np.zeros(n), np.full(n, -1))

    def prune(self) -> None:
        """A split whose sides are leaves that say the same is a leaf, as in Spark's forests."""
        for node in range(len(self.feature) // 2 - 1, -1, -1):
            a, b = 2 * node + 1, 2 * node + 2
            if self.feature[node] >= 0 and self.feature[a] < 0 and self.feature[b] < 0 and self.says[a] == self.says[b]:
                self.feature[node] = -1


def reached(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """Each row's heap node after so many steps; beyond a leaf it goes on to the left."""
    n = x.shape[1]
    flat, rows = x.reshape(-1), np.arange(n)
    first = np.maximum(feature, 0) * n
    last = np.where(feature < 0, 255, cut).astype(np.uint8)
    node = np.zeros(n, np.int64)
    for _ in range(steps):
        right = flat[first[node] + rows] > last[node]
        node = 2 * node + 1 + right
    return node


def gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(total > 0, 1 - ((counts / total[..., None]) ** 2).sum(-1), 0.0)


def fit_forest(table: Packed, columns: list[str], trees: int, depth: int, seed: int) -> list[Tree]:
    """Trees of at most depth levels on bootstrapped rows; a node chooses among ceil(sqrt(columns)) features by Gini gain.

    Features of a tree are numbered as in columns.
    """
    at, classes, seed = table.places(columns), table.classes, seed % 2**64
    some = len(columns) if trees == 1 else math.ceil(math.sqrt(len(columns)))
    rng = np.random.default_rng([seed, 1])
    grown = [Tree.of(depth) for _ in range(trees)]
    active = [[0] for _ in range(trees)]
    for level in range(depth):
        if not any(active):
            break
        choice = [np.stack([np.sort(rng.choice(len(columns), some, replace=False)) for _ in nodes]) if nodes else np.zeros((0, some), int) for nodes in active]
        got = table.added(_counting(grown, active, choice, at, level, some, classes, seed))
        base = 0
        for t, (tree, nodes) in enumerate(zip(grown, active, strict=True)):
            size = len(nodes) * some * BINS * classes
            cells = got[base : base + size].reshape(len(nodes), some, BINS, classes)
            base += size
            below = []
            for j, node in enumerate(nodes):
                below += _split(tree, node, cells[j], choice[t][j], level + 1 == depth)
            active[t] = below
    for tree in grown:
        tree.prune()
    return grown


def _split(tree: Tree, node: int, cells: np.ndarray, chosen: np.ndarray, last: bool) -> list[int]:
    """Puts the node's best split into the tree; its children that may be split in turn."""
    whole = cells[0].sum(0)
    weight = whole.sum()
    tree.weight[node], tree.says[node] = weight, int(whole.argmax())
    left = cells.cumsum(1)[:, :-1]
    right = whole - left
    nl, nr = left.sum(-1), right.sum(-1)
    gain = gini(whole) - (nl * gini(left) + nr * gini(right)) / max(weight, 1.0)
    gain = np.where((nl >= 1) & (nr >= 1), gain, -1.0)
    j, b = np.unravel_index(gain.argmax(), gain.shape)
    if gain[j, b] <= 0:
        return []
    tree.feature[node], tree.cut[node], tree.gain[node] = chosen[j], b, gain[j, b]
    below = []
    for child, counts in ((2 * node + 1, left[j, b]), (2 * node + 2, right[j, b])):
        tree.weight[child], tree.says[child] = counts.sum(), int(counts.argmax())
        if not last and gini(counts) > 1e-12:
            below.append(child)
    return below


def _counting(grown: list[Tree], active: list[list[int]], choice: list[np.ndarray], at: np.ndarray, level: int, some: int, classes: int, seed: int):
    shapes = [(np.where(t.feature < 0, -1, at[np.maximum(t.feature, 0)]), t.cut.copy()) for t in grown]
    looked = [at[c] for c in choice]
    weighed = len(grown) > 1  # a single tree has each row once

    def count(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        out = [np.zeros(len(nodes) * some * BINS * classes) for nodes in active]
        for b in blocks:
            n = len(b.y)
            x, y, rows = np.ascontiguousarray(b.x), b.y.astype(np.int64), np.arange(n)
            flat = x.reshape(-1)
            for t, nodes in enumerate(active):
                if not nodes:
                    continue
                slots = np.full(2 ** (level + 1), -1)
                slots[np.array(nodes) - (2**level - 1)] = np.arange(len(nodes))
                slot = slots[reached(x, *shapes[t], level) - (2**level - 1)]
                w = _POISSON[np.random.default_rng([seed, 2, t, b.id]).integers(0, 1 << 16, n, np.uint16)] if weighed else np.ones(n)
                keep = np.flatnonzero((slot >= 0) & (w > 0))
                slot, w, own, cls = slot[keep], w[keep], rows[keep], y[keep]
                for j in range(some):
                    bins = flat[looked[t][slot, j] * n + own]
                    out[t] += np.bincount(((slot * some + j) * BINS + bins) * classes + cls, w, len(out[t]))
        yield np.concatenate(out)

    return count


def importances_of(grown: list[Tree], columns: int) -> list[float]:
    """Gains weighted by rows, each tree's to a sum of 1, then all to a sum of 1."""
    total = np.zeros(columns)
    for t in grown:
        inner = t.feature >= 0
        own = np.bincount(t.feature[inner], (t.gain * t.weight)[inner], columns)
        total += own / own.sum() if own.sum() > 0 else 0
    return (total / total.sum() if total.sum() > 0 else total).tolist()
