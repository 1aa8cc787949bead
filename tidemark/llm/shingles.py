"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import LOWER, mix, row_blocks, scan, seeds, text_buffer


def shingle_rows(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its set of word shingles, as distinct hashes in ascending order.

    A-Z counts as a-z; words are runs without ASCII white space.  A text with
    fewer words than ``width`` has its whole word sequence as its one shingle; without
    words (or null) it has none.
    """
    factors = seeds(width, 11) | np.uint64(1)
    ends = seeds(width + 1, 12)
    raw, offsets = text_buffer(column)
    for i, j in row_blocks(offsets):
        words = scan(LOWER[raw[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i])
        h, n = words.hashes, len(words.hashes)
        full = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            full += h[k : n - width + 1 + k] * factors[k]
        full = mix(full)
        for a, b in zip(words.rows[:-1], words.rows[1:], strict=True):
            if b - a >= width:
                s = np.sort(full[a : b - width + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                yield mix(np.add.reduce(h[a:b] * factors[: b - a], keepdims=True) + ends[b - a : b - a + 1])
            else:
                yield np.zeros(0, np.uint64)


class FastSketch:
    """Fast similarity sketching: t coordinates, each filled, in O(t log t + set size) expected time.

    Round i hashes every element to a bin and a value that grows with i; after
    t such rounds, round t + b puts every element into bin b.  The least value
    wins a bin and rounds end once no bin is empty, so that later rounds only
    fill gaps.  Two sets agree on a coordinate with the probability of their
    Jaccard similarity, concentrated as with independent coordinates.
    """

    def __init__(self, t: int, salt: int = 21):
        self.t = t
        self.seeds = seeds(2 * t, salt)

    def __call__(self, items: np.ndarray) -> np.ndarray:
        t = self.t
        out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
        i = 0
        while i < 2 * t and len(items):
            # Several rounds at once for small sets: what a later round adds never beats an earlier one.
            some = min(2 * t - i, max(1, 2 * t // len(items)))
            x = mix(items[None, :] ^ self.seeds[i : i + some, None])
            low = x & np.uint64(0xFFFFFFFF)
            bins = ((low * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
            rounds = np.arange(i, i + some)
            late = rounds >= t
            bins[late] = (rounds[late] - t)[:, None]
            value = (x >> np.uint64(24)) | (rounds.astype(np.uint64) << np.uint64(40))[:, None]
            np.minimum.at(out, bins.ravel(), value.ravel())
            i += some
            if out.max() != np.iinfo(np.uint64).max:
                break
        return out


def band_hashes(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash for each of the bands that a sketch is cut into."""
    rows = sketch.reshape(bands, -1)
    total = (rows * (seeds(rows.shape[1], 31) | np.uint64(1))[None, :]).sum(axis=1, dtype=np.uint64)
    return mix(total + seeds(bands, 32))
