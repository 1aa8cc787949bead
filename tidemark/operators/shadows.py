"""Shadow columns: each column's values under a permutation of all rows of its own."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..sources.stored import stored
from .packed import Packed, with_packed_shadows

#: The column of numbered() by which with_shadows() knows that rows are numbered.
RANK = "__rank"
_AT_ONCE = 1 << 18  # rows whose values a task packs together
_ROUNDS = 4
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df stored, with 0, 1, 2, ... in an arbitrary but fixed order; equal rows get different numbers in place.

    No shuffle: a row's number is its place in its file's task after the rows of the tasks before, whose counts
    (one for each task) are all that the driver sees.
    """
    placed = stored(df.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("__place", 33)
    counts = sorted(placed.groupBy(task.alias("task")).count().collect())
    bases, total = [], 0
    for k, n in counts:
        bases.append((k, total))
        total += n
    if not bases:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("__place")
    base = df.sparkSession.createDataFrame(bases, "__task long, __base long")
    rows = placed.withColumn("__task", task).join(F.broadcast(base), "__task")
    return rows.withColumn(name, F.col("__base") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))).drop("__place", "__task", "__base")


def permute(rank: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudo-random permutation of 0 .. n - 1, chosen by key, at the given ranks.

    A Feistel network over pairs of digits below ceil(sqrt(n)); images that are no rank are permuted again,
    which keeps it one to one.
    """
    side = math.isqrt(n - 1) + 1 if n > 1 else 1
    out = rank.astype(np.uint64)
    left = np.arange(len(out))
    salt = np.uint64((key * 0x2545F4914F6CDD1D) & (2**64 - 1))
    while len(left):
        high, low = np.divmod(out[left], np.uint64(side))
        for k in range(_ROUNDS):
            x = (low + np.uint64(k + 1) * salt) * _STEP
            x = (x ^ (x >> np.uint64(31))) * _MIX
            x ^= x >> np.uint64(29)
            high, low = low, (high + x % np.uint64(side)) % np.uint64(side)
        out[left] = high * np.uint64(side) + low
        left = left[out[left] >= n]
    return out.astype(np.int64)


def with_shadows(df: DataFrame | Packed, columns: list[str], seed: int) -> tuple[DataFrame | Packed, list[str]]:
    """(df with shadow_<column> for each of the columns, their names).

    A shadow holds its column's values, each once, in the order of a permutation of all rows that differs from column to column:
    it keeps the distribution and loses any tie to the other columns.  Rows are numbered once (numbered() before with RANK, if
    several calls share the rows) and dealt in blocks of neighbouring numbers, so equal rows do not meet in a task.  A task sends
    its values packed, one array for each column and block, and each block's task puts them in place beside the
    block's own rows: one shuffle, and nothing is held but a block.  The numbered rows are stored, so a retry moves the same values.

    Numbers are moved as doubles.  Nulls move like values.  Of packed rows, bins are moved (with_packed_shadows()).
    """
    if isinstance(df, Packed):
        return with_packed_shadows(df, columns, seed)
    names = [f"shadow_{c}" for c in columns]
    rows = df if RANK in df.columns else numbered(df, RANK)
    n = rows.count()
    if not n or not columns:
        return rows.drop(RANK).withColumns({s: F.col(c) for s, c in zip(names, columns, strict=True)}), names
    keys = [seed * 1_000_003 + k + 1 for k in range(len(columns))]
    size = min(1 << 16, max(1 << 12, n >> 8))

    def pack(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches)
        rank = whole.column(0).to_numpy()
        for k, key in enumerate(keys):
            at = permute(rank, n, key)
            order = np.argsort(at, kind="stable")
            block, place = np.divmod(at[order], size)
            firsts = np.flatnonzero(np.diff(block, prepend=-1))
            own = whole.column(k + 1)
            ends = np.append(firsts, len(block))
            cells = [(place, np.uint16), (own.fill_null(0.0).to_numpy()[order], np.float64), (own.is_null().to_numpy()[order], np.uint8)]
            packed = [pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer((ends * np.dtype(t).itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(v, t))]) for v, t in cells]
            yield pa.RecordBatch.from_arrays([pa.array(block[firsts]), pa.array(np.full(len(firsts), k, np.int32)), *packed], ["__block", "k", "place", "x", "none"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= _AT_ONCE:
                yield from pack(held)
                held, count = [], 0
        if count:
            yield from pack(held)

    def place(own: pa.Table, sent: pa.Table) -> pa.Table:
        own = own.sort_by(RANK)
        at = own.column(RANK).to_numpy() % size
        where = [np.frombuffer(b"".join(sent.column(c).to_pylist()), t) for c, t in (("place", np.uint16), ("x", np.float64), ("none", np.uint8))]
        k = np.repeat(sent.column("k").to_numpy(), pc.binary_length(sent.column("place")).to_numpy() // 2)
        x, none = np.zeros((len(keys), size)), np.ones((len(keys), size), bool)
        x[k, where[0]], none[k, where[0]] = where[1], where[2]
        for j, s in enumerate(names):
            own = own.append_column(s, pa.array(x[j][at], mask=none[j][at]))
        return own.drop_columns(["__block"])

    sent = rows.select(RANK, *(F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns))).mapInArrow(send, "__block long, k int, place binary, x binary, none binary")
    schema = StructType([*rows.schema.fields, *(StructField(s, DoubleType()) for s in names)])
    blocks = rows.withColumn("__block", F.floor(F.col(RANK) / F.lit(size)))
    placed = blocks.groupBy("__block").cogroup(sent.groupBy("__block")).applyInArrow(place, schema)
    kinds = dict(df.dtypes)
    return placed.withColumns({s: F.col(s).cast(kinds[c]) for c, s in zip(columns, names, strict=True)}).drop(RANK), names
