"""Vectorised word scanning of Arrow text columns.

Python loops over words cost about a microsecond each; a corpus has far too
many words for that.  Here a whole block of rows is scanned with numpy: byte
classes give word edges, and a polynomial over random byte values gives every
word a 64-bit hash.  Only words not seen before are looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values for one purpose (salt)."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(_STEP))


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: The white space of ``[^\x20\x09-\x0D]+``.
SPACES = byte_class(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTES = seeds(256, 7)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i modulo 2**64 for i below n; kept between calls."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        made = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = tuple(made)
    return _powers


@dataclass
class Words:
    """Words of a block of rows: byte spans, hashes, and where each row's begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray  # len(rows) == number of rows + 1, indexes into starts


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw, at - at[0] if len(at) else np.zeros(1, np.int64)


def row_blocks(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes each; a longer row comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def _scan_piece(raw, first, gaps, before, after, base):
    inside = ~gaps[raw]
    prior = np.empty_like(inside)
    prior[:1] = False
    prior[1:] = inside[:-1]
    opens = inside & ~prior
    if before is not None:
        opens[1:] |= after[raw[:-1]] & before[raw[1:]]
    edge = first[first < len(raw)]
    opens[edge] = inside[edge]
    starts = np.flatnonzero(opens)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64)
    # A word ends at the next gap or the next start, whichever comes first.
    stops = np.flatnonzero(~inside)
    ends = np.append(starts[1:], len(raw))
    if len(stops):
        k = np.searchsorted(stops, starts)
        ends = np.minimum(ends, np.append(stops, len(raw))[k])
    up, down = powers(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return starts + base, ends + base, hashes


def scan(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACES, before: np.ndarray | None = None, after: np.ndarray | None = None) -> Words:
    """Words of rows: maximal runs without a byte of gaps.

    before, after: a word also ends between a byte of ``after`` and a byte of
    ``before``.  Works through long texts in pieces cut at gaps, so memory
    follows the piece and not the text.
    """
    pieces, at = [], 0
    while at < len(raw):
        to = min(len(raw), at + BLOCK)
        while to < len(raw):
            ahead = np.flatnonzero(gaps[raw[to : to + BLOCK]])
            if len(ahead):
                to += int(ahead[0])
                break
            to = min(len(raw), to + BLOCK)
        lo, hi = np.searchsorted(offsets, (at, to))
        pieces.append(_scan_piece(raw[at:to], offsets[lo:hi] - at, gaps, before, after, at))
        at = to
    if not pieces:
        pieces = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    starts, ends, hashes = (np.concatenate(x) if len(pieces) > 1 else x[0] for x in zip(*pieces, strict=True))
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


class Table64:
    """Open-addressing map from 64-bit hashes to small integers, looked up for whole arrays."""

    def __init__(self, bits: int = 16, most_bits: int = 21):
        self.bits, self.most_bits = bits, most_bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.used = 0

    def full(self, more: int) -> bool:
        return (self.used + more) * 2 > 1 << self.most_bits

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The values; -1 where a hash has none."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (hashes & mask).astype(np.int64)
        out = self.values[slot]
        wrong = np.flatnonzero((self.keys[slot] != hashes) & (out >= 0))
        while len(wrong):
            slot = (slot[wrong] + 1) & int(mask) if len(slot) != len(wrong) else (slot + 1) & int(mask)
            got = self.values[slot]
            miss = (self.keys[slot] != hashes[wrong]) & (got >= 0)
            out[wrong] = got
            wrong, slot = wrong[miss], slot[miss]
        return out

    def put(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct hashes that are not there yet."""
        while (self.used + len(hashes)) * 2 > len(self.keys):
            keep = self.values >= 0
            old = self.keys[keep], self.values[keep]
            self.bits = len(self.keys).bit_length()
            self.clear()
            self._insert(*old)
        self._insert(hashes, values.astype(np.int32))

    def _insert(self, hashes, values):
        mask = len(self.keys) - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.values[slot] < 0
            at, who = slot[free], left[free]
            self.values[at] = values[who]  # the last of several that want a slot gets it
            self.keys[at] = hashes[who]
            done = np.zeros(len(left), bool)
            done[free] = self.keys[at] == hashes[who]
            left, slot = left[~done], (slot[~done] + 1) & mask
        self.used += len(hashes)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
