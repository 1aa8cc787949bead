"""Document quality by regularised quadratic discriminant analysis.

Each class is a Gaussian over transformed document statistics.  Covariances are
shrunk towards the pooled one and towards a multiple of the identity, and kept
as Cholesky factors: a score is a difference of two log densities, each one
triangular product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_rules import labelled_sample
from .words import byte_class, row_blocks, scan, text_buffer

#: Bytes that are counted: capitals, digits, symbols, sentence marks, other ASCII marks, line ends, bytes beyond ASCII.
_CLASSES = (
    byte_class(bytes(range(65, 91))),
    byte_class(b"0123456789"),
    byte_class(b"#*$%&|<>"),
    byte_class(b"!?"),
    byte_class(b".,;:'\"()-"),
    byte_class(b"\n"),
    byte_class(bytes(range(128, 256))),
)
STATISTICS = ("words", "word_length", "upper", "digits", "symbols", "exclaims", "marks", "lines", "beyond_ascii", "distinct", "same_as_last")


def document_statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed STATISTICS for every text: logarithms of counts and of smoothed shares."""
    raw, offsets = text_buffer(column)
    out = np.zeros((len(offsets) - 1, len(STATISTICS)))
    for i, j in row_blocks(offsets):
        block, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        words = scan(block, at)
        n = np.diff(words.rows).astype(float)
        total = np.append(0, np.cumsum(words.ends - words.starts))[words.rows]
        chars = np.diff(total).astype(float)
        rows = out[i:j]
        rows[:, 0] = np.log1p(n)
        rows[:, 1] = np.log((chars + 5) / (n + 1))
        for k, c in enumerate(_CLASSES):
            count = np.diff(np.append(0, np.cumsum(c[block], dtype=np.int64))[at])
            rows[:, 2 + k] = np.log((count + 0.5) / (chars + 20))
        owner = np.repeat(np.arange(j - i), np.diff(words.rows))
        order = np.lexsort((words.hashes, owner))
        h, o = words.hashes[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        rows[:, 9] = np.log((np.bincount(o[fresh], minlength=j - i) + 5) / (n + 5))
        again = np.zeros(len(owner), bool)
        again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
        rows[:, 10] = np.log((np.bincount(owner[again], minlength=j - i) + 0.5) / (n + 20))
    return out


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Two Gaussians as means and inverse Cholesky factors, and the logistic map of their log ratio to a score."""

    means: np.ndarray
    whiten: np.ndarray
    offsets: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        logs = [o - 0.5 * np.square((x - m) @ w.T).sum(axis=1) for m, w, o in zip(self.means, self.whiten, self.offsets, strict=True)]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        # A signed root tames the quadratic tails before calibration.
        z = self.margin(x)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.sign(z) * np.sqrt(np.abs(z)) + self.shift, -40, 40)))


def fit_discriminant(x: np.ndarray, y: np.ndarray, pooled: float = 0.1, ridge: float = 0.02) -> QuadraticDiscriminant:
    """pooled, ridge: weights of the pooled covariance and of the mean variance in each class covariance.

    With one class only, or none, every score is that class's (0.5 without rows).
    """
    d = x.shape[1]
    if len(x) == 0 or len(np.unique(y)) < 2:
        share = y.mean() if len(x) else 0.5
        return QuadraticDiscriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), 1.0, float(np.log((share * len(x) + 0.5) / ((1 - share) * len(x) + 0.5))))
    parts = [x[y == c] for c in (0, 1)]
    means = np.array([p.mean(axis=0) for p in parts])
    scatter = [(p - m).T @ (p - m) / max(1, len(p) - 1) for p, m in zip(parts, means, strict=True)]
    within = sum(len(p) * s for p, s in zip(parts, scatter, strict=True)) / len(x)
    whiten, offsets = [], []
    for p, s in zip(parts, scatter, strict=True):
        cov = (1 - pooled - ridge) * s + pooled * within + ridge * np.trace(within) / d * np.eye(d) + 1e-9 * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        offsets.append(np.log(len(p) / len(x)) - np.log(np.diag(factor)).sum())
    model = QuadraticDiscriminant(means, np.array(whiten), np.array(offsets))
    z = model.margin(x)
    z = np.sign(z) * np.sqrt(np.abs(z))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a penalised logistic fit
        q = 1 / (1 + np.exp(-np.clip(slope * z + shift, -40, 40)))
        w = q * (1 - q)
        grad = np.array([((q - y) * z).sum() + 1e-2 * slope, (q - y).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        size = min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        slope, shift = slope - size * step[0], shift - size * step[1]
        if np.abs(step).max() < 1e-6:
            break
    return QuadraticDiscriminant(model.means, model.whiten, model.offsets, float(max(slope, 1e-3)), float(shift))


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> QuadraticDiscriminant:
    """Fit on at most ``most`` labelled documents; only their statistics, a dozen numbers each, reach the driver."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = document_statistics(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c) for c in x.T)], ["label", *STATISTICS])

    rows = labelled_sample(docs, labels, "quality", most).select("text", "label").mapInArrow(measure, "label int, " + ", ".join(f"{s} double" for s in STATISTICS)).collect()
    data = np.array(rows, float).reshape(-1, 1 + len(STATISTICS))
    data = data[np.lexsort(data.T)]
    return fit_discriminant(data[:, 1:], data[:, 0])


def score_quality(docs: DataFrame, model: QuadraticDiscriminant) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every text.

    Null texts score like empty ones; repeated rows and null ids stay; an
    empty table gives no rows.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(document_statistics(batch.column(1))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")


def keep_by_score(docs: DataFrame, model: QuadraticDiscriminant, least: float = 0.7) -> DataFrame:
    """The rows of docs, with their own columns, that score at least so much."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(document_statistics(batch.column(at))) >= least))

    return docs.mapInArrow(keep, docs.schema)


def held_out(modulus: int, remainder: int):
    """True where crc32 of doc_id as text leaves that remainder: rows no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))
