"""Sums over all pairs of columns, by blocks of columns and with a null mask for each pair."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block: its sums are five matrices of this many squared doubles in a task.
BLOCK = 256
#: Rows that a shift is taken from; it only keeps digits, so any rows do.
_SHIFT_ROWS = 1000
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _centre(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """A value near each column's middle, from a few rows; sums of differences from it keep their digits."""
    near = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).limit(_SHIFT_ROWS).agg(*(F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in columns)).first()
    return {c: x if (x := near[c]) is not None and np.isfinite(x) else 0.0 for c in columns}


def pair_sums(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """a, b, n, sx, sy, sxx, syy, sxy for each pair a < b by name: sums over the rows where both have a value.

    Values are taken relative to a fixed value near the column's middle, the same in all tasks, so that large
    means do not use up the digits.

    The plan has the same size for any number of columns.  A row enters once for each pair of column blocks, with those
    blocks' columns only (once in all up to ``block`` columns); a task multiplies its batches' value and mask matrices
    and gives one row for each pair of columns at its end, so what is shuffled depends on columns and tasks, not on rows.
    """
    names = sorted(columns)
    shift = _centre(df, names)
    cells = F.array(*(F.col(c).cast("double") - F.lit(shift[c]) for c in names))
    blocks = [names[k : k + block] for k in range(0, len(names), block)]
    starts = [k * block for k in range(len(blocks))]
    tasks = list(combinations_with_replacement(range(len(blocks)), 2))
    rows = df.select(cells.alias("x"))
    if len(tasks) > 1:
        each = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in tasks))
        rows = rows.select("x", F.explode(each).alias("at"))
        part = {s: F.slice("x", F.col(f"at.{s}") * block + 1, block) for s in "ij"}
        rows = rows.select(F.col("at.i").alias("i"), F.col("at.j").alias("j"), part["i"].alias("x"), part["j"].alias("y"))
    else:
        rows = rows.select(F.lit(0).alias("i"), F.lit(0).alias("j"), "x", F.array().cast("array<double>").alias("y"))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for b in batches:
            at = np.stack([b.column(k).to_numpy() for k in range(2)], axis=1)
            for i, j in np.unique(at, axis=0).tolist():
                own = pa.array(np.flatnonzero((at == (i, j)).all(1)))
                x = matrix(b.column(2).take(own))
                y = matrix(b.column(3).take(own)) if i != j else x
                mx, my = ~np.isnan(x), ~np.isnan(y)
                x, y = np.where(mx, x, 0.0), np.where(my, y, 0.0)
                fx, fy = mx.astype(np.float64), my.astype(np.float64)
                made = [fx.T @ fy, x.T @ fy, fx.T @ y, (x * x).T @ fy, fx.T @ (y * y), x.T @ y]
                have = held.get((i, j))
                held[i, j] = made if have is None else [p + q for p, q in zip(have, made, strict=True)]
        for (i, j), sums in held.items():
            a, b = np.triu_indices(len(sums[0]), 1) if i == j else (g.ravel() for g in np.indices(sums[0].shape))
            out = [pa.array((a + starts[i]).astype(np.int32)), pa.array((b + starts[j]).astype(np.int32)), *(pa.array(s[a, b]) for s in sums)]
            yield pa.RecordBatch.from_arrays(out, ["ka", "kb", *_SUMS])

    made = rows.mapInArrow(multiply, "ka int, kb int, " + ", ".join(f"{s} double" for s in _SUMS))
    total = made.groupBy("ka", "kb").agg(*(F.sum(s).alias(s) for s in _SUMS))
    known = F.array(*(F.lit(c) for c in names))
    return total.select(known[F.col("ka")].alias("a"), known[F.col("kb")].alias("b"), F.col("n").cast("long").alias("n"), *_SUMS[1:])


def pair_correlations(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """a, b, n, r for each pair of columns in name order; r is null where a column is constant on the pair's rows.

    NaN counts as missing.  Without rows there are no pairs.
    """
    s = pair_sums(df, columns, block)
    n = F.col("n")
    vx, vy, c = (n * F.col(p) - F.col(q) * F.col(t) for p, q, t in (("sxx", "sx", "sx"), ("syy", "sy", "sy"), ("sxy", "sx", "sy")))
    # A constant column's variance is rounding alone.
    real = (vx > 1e-13 * n * F.col("sxx")) & (vy > 1e-13 * n * F.col("syy"))
    r = F.when(real, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c / (F.sqrt(vx) * F.sqrt(vy)))))
    return s.select("a", "b", "n", r.alias("r"))
