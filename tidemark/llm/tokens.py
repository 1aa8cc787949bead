"""Whole texts to token ids with a published tokenizer, at numpy speed.

The tokenizer's pre-tokens never cross white space, so a text's ids are the
ids of its words, one after the other.  Each distinct word goes through the
tokenizers library once per worker and is kept in a bounded table.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .words import Table64, byte_class, scan, spans, text_buffer

#: Only these separate words here; rarer white space stays inside a word and is left to the tokenizer.
_GAPS = byte_class(b" \t\n\r")
_LETTERS = byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))
#: ASCII marks that always end a run of ASCII letters (an apostrophe can belong to a contraction).
_MARKS = byte_class(bytes(x for x in range(33, 127) if not chr(x).isalnum() and x != 39))
#: Words that are one pre-token and that normalising leaves alone: a-z and the small letters of Latin-1.
_PLAIN = re.compile(b"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+").fullmatch
_loaded: dict[int, "Encoder"] = {}


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(source: str) -> "Encoder":
    """The worker's encoder for a tokenizer given as JSON; kept between tasks."""
    key = hash(source)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(source)
    return _loaded[key]


class Encoder:
    """Ids of text columns; same as ``encode(text, add_special_tokens=False)`` for each row.

    Words are cut at ASCII white space and where an ASCII letter is followed by
    an ASCII mark; A-Z becomes a-z unless a non-ASCII byte follows (it might be
    a combining mark, which has to meet the capital).  Both leave the ids as they are for a
    tokenizer whose normaliser lower-cases and whose pre-tokens are runs of
    letters, single digits and runs of other marks.  Rows that hold a special
    token's string go to the tokenizer whole.
    """

    def __init__(self, source: str, most_bits: int = 22):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The characters that byte-level models use for bytes: printable ones stand for themselves, the rest follow U+0100.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: b for b in own} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in own)}
        self.direct = True
        probe = [b"and", b"onthtionhent", "él\u00e8ñó".encode(), b"z"]
        self.direct = self._ids(probe) == [e.ids for e in self._whole([w.decode() for w in probe])]
        self.known = Table64(16, most_bits)
        self._reset()

    def _reset(self):
        self.known.clear()
        self.pool = np.zeros(1 << 18, np.uint16)
        self.filled = 0
        self.begin = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)

    def _whole(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        plain = [self.direct and _PLAIN(w) is not None for w in words]
        rest = iter(self._whole([w.decode("utf-8", "replace") for w, p in zip(words, plain, strict=True) if not p]))
        cut = self.tokenizer.model.tokenize
        return [[t.id for t in cut(w.decode("latin-1").translate(self.letters))] if p else next(rest).ids for w, p in zip(words, plain, strict=True)]

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids = self._ids(words)
        count = np.array([len(x) for x in ids], np.int32)
        flat = np.array([x for w in ids for x in w], np.uint32)
        if len(flat) and flat.max() > 65535 and self.pool.dtype != np.uint32:
            self.pool = self.pool.astype(np.uint32)
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        first = self.known.used
        while first + len(words) > len(self.begin):
            self.begin, self.count = np.append(self.begin, np.zeros_like(self.begin)), np.append(self.count, np.zeros_like(self.count))
        self.pool[self.filled : self.filled + len(flat)] = flat
        self.begin[first : first + len(words)] = self.filled + np.cumsum(count) - count
        self.count[first : first + len(words)] = count
        self.filled += len(flat)
        self.known.put(hashes, np.arange(first, first + len(words)))

    def _block(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lower = (raw >= 65) & (raw <= 90)
        lower[:-1] &= raw[1:] < 128
        cased, raw = raw, raw + (lower.astype(np.uint8) << 5)
        words = scan(raw, offsets, _GAPS, _MARKS, _LETTERS)
        at = self.known.get(words.hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            _, one = np.unique(words.hashes[new], return_index=True)
            if self.known.full(len(one)):
                self._reset()
                new = np.arange(len(at))
                _, one = np.unique(words.hashes, return_index=True)
            one = new[one]
            for k in range(0, len(one), 4096):
                part = one[k : k + 4096]
                self._learn(words.hashes[part], [raw[a:b].tobytes() for a, b in zip(words.starts[part], words.ends[part], strict=True)])
            at[new] = self.known.get(words.hashes[new])
        count = self.count[at].astype(np.int64)
        ids = self.pool[spans(self.begin[at], count)]
        ends = np.append(0, np.cumsum(count))[words.rows]
        low = raw.tobytes()
        if not any(x in low for x in self.special):
            return ids, ends
        rows = []
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            odd = any(x in low[a:b] for x in self.special)
            rows.append(np.array(self._whole([cased[a:b].tobytes().decode()])[0].ids, np.uint32) if odd else ids[ends[k] : ends[k + 1]])
        return np.concatenate(rows), np.append(0, np.cumsum([len(x) for x in rows]))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, and the n + 1 offsets of its rows."""
        from .words import row_blocks

        raw, offsets = text_buffer(column)
        ids, ends = [], [np.zeros(1, np.int64)]
        for i, j in row_blocks(offsets):
            a, b = offsets[i], offsets[j]
            got, at = self._block(raw[a:b], offsets[i : j + 1] - a)
            ids.append(got)
            ends.append(at[1:] + ends[-1][-1])
        return np.concatenate(ids) if ids else np.zeros(0, np.uint16), np.concatenate(ends)
