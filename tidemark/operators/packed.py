"""Rows packed for tree fits: a byte for each value, its bin, in blocks of rows that a pass reads as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32  # as Spark's trees have by default
_BLOCK = 1 << 16  # rows of a block at most
_TASK = 1 << 20  # rows of a task, about
_FINE = 4000  # values of a summary, from which cuts are taken
_SORTED = 1 << 18  # rows that a task sorts together for it


@dataclass
class Block:
    """Rows of one block: their number among the blocks, labels, and a row of bins for each column."""

    id: int
    y: np.ndarray
    x: np.ndarray


@dataclass
class Packed:
    """A table of bins: its blocks, their sizes in order, and for each column the values that part its bins."""

    blocks: RDD
    sizes: list[int]
    columns: list[str]
    cuts: dict[str, np.ndarray]
    target: str
    classes: int  # labels are below

    def count(self) -> int:
        return sum(self.sizes)

    def places(self, columns: list[str]) -> np.ndarray:
        at = {c: k for k, c in enumerate(self.columns)}
        return np.array([at[c] for c in columns], np.int64)

    def added(self, f: Callable[[Iterator[Block]], Iterator[np.ndarray]]) -> np.ndarray:
        """The sum of the arrays that f makes of the tasks' blocks, one for each task."""
        out = self.blocks.mapPartitions(f)
        parts = out.treeReduce(np.add, 2) if self.blocks.getNumPartitions() > 256 else out.collect()
        return parts if isinstance(parts, np.ndarray) else np.sum(parts, axis=0)

    def unpersist(self) -> None:
        self.blocks.unpersist()


def condensed(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with the weight up to each from the one before; of more than most, every so many by weight."""
    order = np.argsort(values, kind="stable")
    values, cum = values[order], np.cumsum(weights[order])
    lasts = np.append(np.flatnonzero(values[1:] != values[:-1]), len(values) - 1)
    values, cum = values[lasts], cum[lasts]
    if len(values) > most:
        kept = np.unique(np.append(0, np.searchsorted(cum, cum[-1] * np.arange(1, most) / (most - 1)).clip(max=len(cum) - 1)))
        values, cum = values[kept], cum[kept]
    return values, np.diff(cum, prepend=0.0)


def cuts_of(df: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, np.ndarray]:
    """The values that part each column's bins, from a summary of all rows whose ranks are right to about a thousandth.

    Up to as many distinct values as bins are parted half-way; of more, those nearest to equal shares are taken.  A value is in
    the bin of the first cut that is not below it.
    """

    def merge(a: tuple, b: tuple) -> tuple:
        return condensed(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), _FINE) if len(a[0]) and len(b[0]) else max(a, b, key=lambda s: len(s[0]))

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, count = None, [], 0

        def more(found: list | None) -> list:
            new = []
            for k in range(len(columns)):
                x = np.concatenate([h[k] for h in held])
                x = np.sort(x[~np.isnan(x)])
                new.append(condensed(x, np.ones(len(x)), _FINE) if len(x) else (x, x))
            return new if found is None else [merge(a, b) for a, b in zip(found, new, strict=True)]

        for b in batches:
            held.append([b.column(k).to_numpy(zero_copy_only=False) for k in range(len(columns))])
            count += b.num_rows
            if count >= _SORTED:
                found, held, count = more(found), [], 0
        if count:
            found = more(found)
        for k, (v, w) in enumerate(found or []):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], ["k", "v", "w"])

    def joined(parts: pa.Table) -> pa.Table:
        v, w = (np.frombuffer(b"".join(parts.column(c).to_pylist())) for c in ("v", "w"))
        v, w = condensed(v, w, 4 * _FINE) if len(v) else (v, w)
        return pa.table({"k": parts.column("k").combine_chunks()[:1], "v": pa.array([v.tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary())})

    made = df.select(*columns).mapInArrow(summary, "k int, v binary, w binary")
    by_column = {r.k: (np.frombuffer(r.v), np.frombuffer(r.w)) for r in made.groupBy("k").applyInArrow(joined, "k int, v binary, w binary").collect()}
    out = {}
    for k, c in enumerate(columns):
        values, weights = by_column.get(k, (np.array([]), np.array([])))
        if len(values) > bins:
            cum = np.cumsum(weights)
            at = np.unique(np.searchsorted(cum, cum[-1] * np.arange(1, bins) / bins).clip(max=len(values) - 2))
        else:
            at = np.arange(max(0, len(values) - 1))
        out[c] = (values[at] + values[at + 1]) / 2 if len(at) else np.array([])
    return out


def packed(df: DataFrame, columns: list[str], target: str, bins: int = BINS) -> Packed:
    """df's columns as bins beside the target; null features count as 0.  df is read twice: for the cuts and for the bins."""
    rows = df.na.fill(0.0, columns).select(*(F.col(c).cast("double").alias(c) for c in columns), F.col(target).cast("double").alias(target))
    cuts = cuts_of(rows, columns, bins)
    sides = [cuts[c] for c in columns]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def block() -> pa.RecordBatch:
            x = np.concatenate([h[0] for h in held], axis=1)
            y = np.concatenate([h[1] for h in held])
            return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["n", "x", "y"])

        for whole in batches:
            for at in range(0, whole.num_rows, _BLOCK):
                b = whole.slice(at, _BLOCK)
                if count + b.num_rows > _BLOCK:
                    yield block()
                    held, count = [], 0
                x = np.stack([np.searchsorted(s, b.column(k).fill_null(0.0).to_numpy(zero_copy_only=False)).astype(np.uint8) for k, s in enumerate(sides)])
                held.append((x, b.column(len(sides)).to_numpy(zero_copy_only=False).astype(np.float32)))
                count += b.num_rows
        if count:
            yield block()

    k = len(columns)
    made = rows.mapInArrow(pack, "n int, x binary, y binary").rdd.map(lambda r: (np.frombuffer(r.y, np.float32), np.frombuffer(r.x, np.uint8).reshape(k, r.n))).persist(StorageLevel.MEMORY_AND_DISK)
    per_task = made.mapPartitionsWithIndex(lambda p, it: [(p, [(len(y), float(y.max())) for y, _ in it])]).collect()
    first, sizes, top = {}, [], 1.0
    for p, found in sorted(per_task):
        first[p] = len(sizes)
        sizes += [n for n, _ in found]
        top = max([top, *(y for _, y in found)])
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-sum(sizes) // _TASK))
    named = made.mapPartitionsWithIndex(lambda p, it: ((first[p] + j, (y, x)) for j, (y, x) in enumerate(it)))
    dealt = named.partitionBy(tasks, int).map(lambda b: Block(b[0], *b[1])).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    made.unpersist()
    return Packed(dealt, sizes, list(columns), cuts, target, int(top) + 1)


def with_packed_shadows(table: Packed, columns: list[str], seed: int) -> tuple[Packed, list[str]]:
    """(the columns and their shadows, the names of the shadows); a shadow is its column under a permutation of all rows.

    Values are shuffled within their block, dealt to all blocks in turn (rows as a matrix read by columns), and shuffled
    within the block they come to, each time in another order for each column.  Every shuffle is seeded by block and column.
    """
    names = [f"shadow_{c}" for c in columns]
    at, n, tasks = table.places(columns), table.count(), table.blocks.getNumPartitions()
    ends = np.cumsum(table.sizes)
    starts = ends - np.asarray(table.sizes)
    wide = max(1, len(ends))
    turn = seed * 7919 % max(1, n)

    def send(b: Block) -> Iterator[tuple]:
        rank = (starts[b.id] + turn + np.arange(len(b.y))) % n
        column, row = rank % wide, rank // wide
        to = column * (n // wide) + np.minimum(column, n % wide) + row
        home = np.searchsorted(ends, to, "right")
        order = np.argsort(home, kind="stable")
        where, counts = np.unique(home, return_counts=True)
        moved = np.stack([np.random.default_rng([seed, b.id, k, 0]).permutation(b.x[c])[order] for k, c in enumerate(at)])
        parts = np.split(moved, np.cumsum(counts)[:-1], axis=1)
        yield b.id, (-1, b.y, b.x[at])
        for h, part in zip(where.tolist(), parts, strict=True):
            yield h, (b.id, None, np.ascontiguousarray(part))

    def place(sent: Iterator[tuple]) -> Iterator[Block]:
        found: dict[int, list] = {}
        for h, message in sent:
            found.setdefault(h, []).append(message)
        for h in sorted(found):
            own, *others = sorted(found.pop(h), key=lambda m: m[0])
            moved = np.concatenate([m[2] for m in others], axis=1)
            for k in range(len(at)):
                moved[k] = np.random.default_rng([seed, h, k, 1]).permutation(moved[k])
            yield Block(h, own[1], np.concatenate([own[2], moved]))

    both = table.blocks.flatMap(send).partitionBy(tasks, int).mapPartitions(place).persist(StorageLevel.MEMORY_AND_DISK)
    cuts = {c: table.cuts[c] for c in columns}
    return Packed(both, table.sizes, [*columns, *names], cuts | {s: table.cuts[c] for c, s in zip(columns, names, strict=True)}, table.target, table.classes), names
