"""Hard negatives by vantage-point trees: score windows are distance annuli, walked from their inner edge."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Rows of a block, which one task holds at a time, and of a leaf of its tree.
_BLOCK, _LEAF = 2048, 128
#: Rows, and values, of the sample that the upper tree is fitted on.
_SAMPLE, _SAMPLE_VALUES = 32768, 1 << 22
#: Anchors that meet a block at once.
_CHUNK = 1024
#: A scaled component is at most this large, so that the scores of up to 8192 components are longs.
_LARGEST = 1 << 25
_FOUND = "anchor_id long, id long, score long"


@dataclass
class _Node:
    """Rows within ``far`` of each ancestor's vantage point; a leaf has a number, others a vantage point and children."""

    leaf: int = -1
    vantage: np.ndarray | None = None
    lift: float = 0.0
    radius: float = 0.0
    children: list[tuple[_Node, float, float]] = field(default_factory=list)


class VantageTree:
    """A vantage-point tree over integer vectors with one more coordinate that gives all of them the same norm.

    With that norm's square ``top``, a query q (its own last coordinate is 0) has
    |q - x|**2 = |q|**2 + top - 2 score: score windows are annuli around q, high scores near.
    """

    def __init__(self, points: np.ndarray, top: int, leaf_size: int):
        self.top, self.leaves = top, []
        self.points = points.astype(np.float64)
        self.lifts = np.sqrt(np.maximum(0.0, top - (self.points**2).sum(1)))
        self.slip = 4e-6 * math.sqrt(top) + 1e-9
        self.root = self._grow(np.arange(len(points)), leaf_size)

    def _far(self, vantage, lift, points, lifts) -> np.ndarray:
        square = (vantage**2).sum() + (points**2).sum(1) - 2 * (points @ vantage) + (lift - lifts) ** 2
        return np.sqrt(np.maximum(0.0, square))

    def _grow(self, rows: np.ndarray, leaf_size: int) -> _Node:
        if len(rows) > leaf_size:
            # The row farthest from the first one: vantage points at the edge split best.
            first = self._far(self.points[rows[0]], self.lifts[rows[0]], self.points[rows], self.lifts[rows])
            at = rows[int(first.argmax())]
            far = self._far(self.points[at], self.lifts[at], self.points[rows], self.lifts[rows])
            radius = float(np.median(far))
            inside = far <= radius
            if not inside.all():
                node = _Node(-1, self.points[at].copy(), float(self.lifts[at]), radius)
                for part in (inside, ~inside):
                    node.children.append((self._grow(rows[part], leaf_size), float(far[part].min()), float(far[part].max())))
                return node
        self.leaves.append(rows)
        return _Node(len(self.leaves) - 1)

    def open_ended(self) -> VantageTree:
        """For rows that the tree has not seen: children reach from 0 to the radius and from there on; points go."""

        def widen(node: _Node) -> None:
            if node.children:
                (a, _, _), (b, _, _) = node.children
                node.children = [(a, 0.0, node.radius), (b, node.radius, math.inf)]
                widen(a)
                widen(b)

        widen(self.root)
        self.points = self.lifts = None
        return self

    def route(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        points = points.astype(np.float64)
        lifts = np.sqrt(np.maximum(0.0, self.top - (points**2).sum(1)))
        out = np.zeros(len(points), np.int32)

        def go(node: _Node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if not node.children:
                out[rows] = node.leaf
                return
            inside = self._far(node.vantage, node.lift, points[rows], lifts[rows]) <= node.radius
            go(node.children[0][0], rows[inside])
            go(node.children[1][0], rows[~inside])

        go(self.root, np.arange(len(points)))
        return out

    def scores(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (row) and leaf (column) the least and the greatest score that its rows can have."""
        queries = queries.astype(np.float64)
        own = (queries**2).sum(1)
        near, far = np.zeros((len(queries), len(self.leaves))), np.full((len(queries), len(self.leaves)), np.inf)

        def go(node: _Node, low: np.ndarray, high: np.ndarray) -> None:
            if not node.children:
                near[:, node.leaf], far[:, node.leaf] = low, high
                return
            d = np.sqrt(np.maximum(0.0, own + self.top - 2 * (queries @ node.vantage)))
            for child, least, most in node.children:
                go(child, np.maximum(low, np.maximum(least - d, d - most)), np.minimum(high, d + most))

        go(self.root, np.zeros(len(queries)), np.full(len(queries), np.inf))
        edge = 1e-9 * self.top + 1e-6
        best = (own[:, None] + self.top - np.maximum(0.0, near - self.slip) ** 2) / 2 + edge
        worst = (own[:, None] + self.top - (far + self.slip) ** 2) / 2 - edge
        return worst, best


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class _Walk:
    """One anchor's walk: rows from the inner edge of its annuli outwards until each window has its k."""

    def __init__(self, high: np.ndarray, floor: np.ndarray, k: int):
        self.high, self.floor, self.k = high.copy(), floor.copy(), k
        self.best = [np.zeros(0, np.int64) for _ in high]
        self.ids, self.scores = [], []

    def wanted(self, worst: float, best: float) -> bool:
        """Whether rows with scores in this range may enter a window."""
        return bool(((self.high >= worst) & (self.floor <= best)).any())

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        took = np.zeros(len(ids), bool)
        for w in range(len(self.high)):
            fits = (scores <= self.high[w]) & (scores >= self.floor[w])
            if fits.any():
                took |= fits
                top = np.sort(np.concatenate((self.best[w], scores[fits])))[::-1][: self.k]
                self.best[w] = top
                if len(top) == self.k:
                    self.floor[w] = max(self.floor[w], top[-1])  # a row that ties may still win by its id
        if took.any():
            self.ids.append(ids[took])
            self.scores.append(scores[took])

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids, scores = np.concatenate(self.ids), np.concatenate(self.scores)
        order = np.lexsort((ids, -scores))
        ids, scores, keep = ids[order], scores[order], np.zeros(len(order), bool)
        for w in range(len(self.high)):
            keep[np.flatnonzero((scores <= self.high[w]) & (scores >= self.floor[w]))[: self.k]] = True
        return ids[keep], scores[keep]


class _Index:
    """All rows in blocks of about _BLOCK rows: leaves of an upper tree, large ones dealt over several blocks.

    The upper tree is fitted on a sample of at most about _SAMPLE rows (fewer where vectors are long), and every row is
    routed to a leaf; each block grows a tree of its own over all its rows when it is met.
    """

    def __init__(self, rows: DataFrame, work: Scratch):
        self.work, self.spark = work, rows.sparkSession
        n, top, width, most = rows.agg(F.count(F.lit(1)), F.max("square"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
        self.n, self.top, self.width = n, int(top or 0), max(1, width or 0)
        #: Sums of products below 2**53 are exact in double precision; beyond, products are summed as integers.
        self.kind = np.float64 if self.width * int(most or 0) ** 2 < 1 << 53 else np.int64
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(self.width) - F.size("v"))))
        self.tree = self.spark.sparkContext.broadcast(self._upper(rows))
        tree, width = self.tree, self.width

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf = tree.value.route(_matrix(b.column(2), width))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])

        routed = rows.select("id", "label", "v", "anchor").mapInArrow(route, "id long, label long, v array<long>, anchor boolean, leaf int")
        routed = work.keep(routed, "routed")
        counts = dict(routed.groupBy("leaf").count().collect())  # a row for each leaf of the upper tree
        self.parts = np.array([math.ceil(counts.get(k, 0) / _BLOCK) for k in range(len(tree.value.leaves))], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.parts)[:-1])).astype(np.int64)
        leaves = self.spark.createDataFrame([(k, int(a), int(b)) for k, (a, b) in enumerate(zip(self.first, self.parts, strict=True))], "leaf int, first long, parts long")
        at = F.col("first") + F.pmod(F.xxhash64("id"), F.greatest("parts", F.lit(1)))
        self.rows = work.keep(routed.join(F.broadcast(leaves), "leaf").select(at.alias("block"), "id", "label", "v", "anchor"), "blocks")
        work.drop("routed")
        self.anchors = self.rows.where("anchor").select(F.col("id").alias("anchor_id"), "label", "v")

    def _upper(self, rows: DataFrame) -> VantageTree:
        wanted = max(256, min(_SAMPLE, _SAMPLE_VALUES // self.width))
        share = min(1.0, wanted / max(1, self.n))
        some = rows if share == 1 else rows.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30)))
        got = some.select("v").limit(2 * wanted).toArrow()
        points = _matrix(got.column(0), self.width) if got.num_rows else np.zeros((1, self.width))
        return VantageTree(points, self.top, max(8, math.ceil(len(points) * _BLOCK / max(1, self.n)))).open_ended()

    def search(self, asked: DataFrame, k: int, same_label: bool, name: str) -> DataFrame:
        """anchor_id, id, score: at least the first k rows of each window of asked (anchor_id, label, v, high, floor).

        A first round lets each anchor meet the block whose leaf reaches its inner edge best; the k-th scores found there
        are floors in the second round, in which it meets every other block that may hold better rows.
        """
        none = F.lit(-1).cast("long")
        near = self.work.keep(self._meet(asked.withColumn("met", none), k, same_label, True, f"{name}-1"), f"{name}-near")
        window = F.posexplode(F.arrays_zip("high", "floor")).alias("w", "at")
        each = asked.select("anchor_id", window).join(near, "anchor_id")
        fits = each.where((F.col("score") <= F.col("at.high")) & (F.col("score") >= F.col("at.floor")))
        place = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "id"))
        full = fits.withColumn("place", place).where(F.col("place") == k).select("anchor_id", F.struct("w", "score").alias("reached"))
        full = full.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list("reached")).alias("reached"))  # one for each window
        met = self.work.spark.read.parquet(f"{self.work.root}/{name}-1-visits").groupBy("anchor_id").agg(F.max("block").alias("met"))
        raised = F.transform("floor", lambda f, w: F.coalesce(F.try_element_at("reached", w), f))
        again = asked.join(full, "anchor_id", "left").join(met, "anchor_id", "left").withColumn("floor", raised)
        again = again.withColumn("met", F.coalesce("met", none)).drop("reached")
        return near.unionByName(self._meet(again, k, same_label, False, f"{name}-2"))

    def _meet(self, asked: DataFrame, k: int, same_label: bool, first_round: bool, name: str) -> DataFrame:
        tree, width, parts, first, top, kind = self.tree, self.width, self.parts, self.first, self.top, self.kind

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A row for each anchor and block to meet."""
            for b in batches:
                worst, best = tree.value.scores(_matrix(b.column(2), width))
                who, blocks = [], []
                for i, (high, floor, met) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)):
                    high, floor = np.array(high), np.array(floor)
                    open_ = (parts > 0) & ((high[:, None] >= worst[i]) & (floor[:, None] <= best[i])).any(0)
                    leaves = np.flatnonzero(open_)
                    if first_round and len(leaves):
                        leaf = leaves[int(best[i][leaves].argmax())]
                        blocks.append([first[leaf] + b.column(0)[i].as_py() % parts[leaf]])
                    else:
                        blocks.append([x for leaf in leaves for x in range(first[leaf], first[leaf] + parts[leaf]) if x != met])
                    who.append(np.full(len(blocks[-1]), i))
                got = b.take(pa.array(np.concatenate(who) if who else [], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks) if who else [], pa.int64()), *got.columns[:5]], ["block", *b.schema.names[:5]])

        asked = asked.select("anchor_id", "label", "v", "high", "floor", "met")
        visits = asked.mapInArrow(visit, "block long, anchor_id long, label long, v array<long>, high array<long>, floor array<long>")
        chunks = max(1, math.ceil(asked.count() / _CHUNK))
        visits = self.work.keep(visits.withColumn("chunk", F.pmod(F.xxhash64("anchor_id"), F.lit(chunks)).cast("int")), f"{name}-visits")

        def walk(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
            if not (rows.num_rows and anchors.num_rows):
                return pa.table([[], [], []], schema=pa.schema([("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]))
            points, queries = _matrix(rows["v"], width), _matrix(anchors["v"], width)
            block = VantageTree(points, top, _LEAF)
            worst, best = block.scores(queries)
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            held = [(ids[x], labels[x], points[x].astype(kind)) for x in block.leaves]
            out = [], [], []
            queries = queries.astype(kind)
            near = np.argsort(-best, axis=1)
            for i, (a, label, high, floor) in enumerate(zip(*(anchors[c].to_pylist() for c in ("anchor_id", "label", "high", "floor")), strict=True)):
                walker = _Walk(np.array(high), np.array(floor), k)
                for leaf in near[i]:
                    if best[i, leaf] < walker.floor.min():
                        break  # so are all leaves behind it
                    if not walker.wanted(worst[i, leaf], best[i, leaf]):
                        continue
                    own, kinds, at = held[leaf]
                    scores = (at @ queries[i]).astype(np.int64)
                    fits = (scores >= walker.floor.min()) & ((kinds == label) == same_label) & (own != a)
                    if fits.any():
                        walker.offer(own[fits], scores[fits])
                got, scores = walker.found()
                for x, y in zip(out, (np.full(len(got), a), got, scores), strict=True):
                    x.append(y)
            return pa.table([np.concatenate(x) for x in out], names=["anchor_id", "id", "score"])

        cells = visits.select(F.col("block").alias("cell"), F.col("chunk").alias("part")).distinct()
        tasks = max(1, min(int(self.parts.sum()) * chunks, 20000))
        rows = self.rows.join(cells.hint("merge"), F.col("block") == F.col("cell")).select("block", F.col("part").alias("chunk"), "id", "label", "v").repartition(tasks, "block", "chunk")
        asked = visits.repartition(tasks, "block", "chunk")
        return rows.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(walk, _FOUND)


def mine_hard_negatives(rows: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, embedding, label.  anchor: which rows are anchors; label: an expression instead of the column.  A score is the
    integer inner product of floor(scale * component).  An anchor's positives are its first rows of the same label; for
    each, its negatives are the first rows of other labels whose scores are from low to high percent of the
    positive's.  Higher scores come first, ties by smaller vec_id.

    Results are exact: trees only rule out what cannot enter a window.  An anchor meets a block only where its annuli reach, and a task
    holds one block of about 2048 rows and at most about 1024 anchors.

    Rows with a null vec_id, label or vector, or a component that is null, not finite or larger than 2**25 once
    scaled, take no part.  A shorter vector counts as ending in zeros.  Rows with one vec_id are one row, the least of
    them by label and vector.  No anchors, no positives or an empty table: no rows.  Other columns may have any name.
    """
    work = Scratch(rows.sparkSession, "negatives")
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    plain = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * scale) <= _LARGEST, F.lit(False)))  # NaN is larger than any number
    of = F.col("label") if label is None else label
    known = rows.select(F.col("vec_id").cast("long").alias("id"), of.cast("long").alias("label"), "embedding", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & plain).select("id", "label", v.alias("v"), "anchor")
    one = known.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("x")).select("id", "x.*")
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    clean = work.keep(one.withColumn("square", square), "clean")
    index = _Index(clean, work)
    edge = F.lit(1 << 62)
    asked = index.anchors.withColumns({"high": F.array(edge), "floor": F.array(-edge)})

    def first(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = work.keep(first(index.search(asked, positives, True, "positive"), ["anchor_id"], positives).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    whole = best.withColumns({"high": F.expr(f"positive_score * {high} div 100"), "floor": F.expr(f"(positive_score * {low} + 99) div 100")})
    windows = whole.where("positive_score >= 0 and floor <= high").groupBy("anchor_id").agg(F.sort_array(F.collect_set(F.struct("high", "floor")), False).alias("w"))  # at most one for each positive
    asked = index.anchors.join(windows, "anchor_id").select("anchor_id", "label", "v", F.col("w.high").alias("high"), F.col("w.floor").alias("floor"))
    found = work.keep(index.search(work.keep(asked, "asked"), negatives, False, "negative"), "found")
    score, positive = F.col("score"), F.col("positive_score")
    fits = best.join(found, "anchor_id").where((positive * low <= score * 100) & (score * 100 <= positive * high))
    out = first(fits, ["anchor_id", "positive_id"], negatives)
    out = work.keep(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "out")
    work.drop_all_but("out")
    return out
