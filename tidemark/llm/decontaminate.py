"""Benchmark passages inside documents: CGK embeddings, bit-sampling LSH, exact edit verification.

The CGK embedding walks through a string and, at every step, moves on by a
random bit of the step and the symbol it stands on.  Strings at a small edit
distance fall back into step after each edit, so their embeddings differ in few
places: edit distance becomes Hamming distance.  Bit sampling hashes a few
places of the embedding; repeated walks and samples reach the target recall.

Symbols are words.  Every word of a document may start an item-sized window.
Windows that share too few word triples with any item to be within the allowed distance are left
out beforehand (the q-gram lemma: no match is lost by that).  Items too short for walks
are looked up whole, at every word, and checked word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, Table64, mix, row_blocks, scan, seeds, text_buffer

_Q = 3
#: Items at once: what a task holds and what is broadcast stays under this many items, whatever the benchmark.
ITEM_BLOCK = 20_000


def item_words(column: pa.Array) -> list[np.ndarray]:
    """Word hashes of every text; A-Z as a-z, words without ASCII white space."""
    raw, offsets = text_buffer(column)
    out: list[np.ndarray] = []
    for i, j in row_blocks(offsets):
        w = scan(LOWER[raw[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i])
        out += [w.hashes[a:b] for a, b in zip(w.rows[:-1], w.rows[1:], strict=True)]
    return out


def edits_allowed(n: int, rate: float) -> int:
    """Word edits that an item of n words may have; at most what leaves a word triple intact."""
    return min(int(rate * n), max(0, (n - _Q) // _Q))


def tables_for(recall: float, rate: float, samples: int) -> int:
    """Hash tables so that a window at the allowed rate of edits is found with at least that chance.

    A sampled place survives an edit rate r with a chance of at least 1 - 3 r
    (an edit and the steps until the walks meet again), measured to be a safe value up to r = 0.2.
    """
    hit = max(0.05, 1 - 3 * rate) ** samples
    return math.ceil(math.log(1 - recall) / math.log(1 - hit))


def closest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of item to a stretch of text, and the stretch (start, end); the shortest of the first."""

    def last_row(pattern, line, anchored):
        m = len(line)
        steps = np.arange(m + 1)
        row = steps.copy() if anchored else np.zeros(m + 1, np.int64)
        for i, w in enumerate(pattern, 1):
            nxt = np.empty(m + 1, np.int64)
            nxt[0] = i
            nxt[1:] = np.minimum(row[:-1] + (line != w), row[1:] + 1)
            row = np.minimum.accumulate(nxt - steps) + steps
        return row

    ends = last_row(item, text, False)
    end = int(ends.argmin())
    back = last_row(item[::-1], text[:end][::-1], True)
    hits = np.flatnonzero(back == ends[end])
    return int(ends[end]), end - (int(hits[0]) if len(hits) else 0), end


@dataclass
class _Class:
    """Items of similar length, which share walks and sampled places."""

    low: int
    high: int
    shared: int  # word triples that any window of a match has in common with its item
    steps: int
    places: np.ndarray  # tables x samples, ascending


class BenchmarkIndex:
    """LSH tables over benchmark items, for the windows of documents."""

    def __init__(self, items: list[np.ndarray], rate: float = 0.2, recall: float = 0.99, samples: int = 3, tables_per_walk: int = 4, least_words: int = 8):
        self.items, self.rate = items, rate
        self.tables = -(-tables_for(recall, rate, samples) // tables_per_walk) * tables_per_walk
        self.per_walk = tables_per_walk
        rng = np.random.default_rng(17)
        lengths = np.array([len(x) for x in items])
        self.classes: list[_Class] = []
        self.walk_seeds = seeds(self.tables // tables_per_walk, 41)
        use = np.flatnonzero(lengths >= least_words)
        #: words of a short item -> its items' places, by how many words it has
        self.short: dict[int, tuple[Table64, np.ndarray, list[list[int]]]] = {}
        for n in sorted({int(x) for x in lengths if 0 < x < least_words}):
            held: dict[bytes, list[int]] = {}
            for i in np.flatnonzero(lengths == n):
                held.setdefault(items[i].tobytes(), []).append(int(i))
            lines = np.array([items[own[0]] for own in held.values()], np.uint64)
            table = Table64(12, 26)
            table.put(self._grams(lines.ravel(), n)[::n], np.arange(len(lines)))
            self.short[n] = table, lines, list(held.values())
        grams = [self._grams(items[i]) for i in use]
        self.gram_table = Table64(12, 26)
        every = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.gram_table.put(every, np.zeros(len(every), np.int64))
        keys, owners = [], []
        low = least_words
        longest = int(lengths.max(initial=0))
        while low <= longest:
            high = max(low, int(low * 1.25))
            own = use[(lengths[use] >= low) & (lengths[use] <= high)]
            if len(own):
                steps = max(samples, 2 * low - 2)
                places = np.sort(np.array([rng.choice(steps, samples, replace=False) for _ in range(self.tables)]), axis=1)
                shared = min(n - _Q + 1 - _Q * edits_allowed(n, rate) for n in range(low, high + 1))
                self.classes.append(_Class(low, high, max(1, shared), steps, places))
                flat = np.concatenate([items[i] for i in own])
                ends = np.cumsum(lengths[own])
                k = self._keys(len(self.classes) - 1, flat, ends - lengths[own], ends)
                keys.append(k.ravel())
                owners.append(np.repeat(own[None, :], self.tables, axis=0).ravel())
            low = high + 1
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.owners = owners[order]
        distinct, first = np.unique(keys[order], return_index=True)
        self.bucket = np.append(first, len(keys))
        self.key_table = Table64(12, 28)
        self.key_table.put(distinct, np.arange(len(distinct)))

    @staticmethod
    def _grams(words: np.ndarray, q: int = _Q) -> np.ndarray:
        f = seeds(q, 42) | np.uint64(1)
        n = max(0, len(words) - q + 1)
        out = np.zeros(n, np.uint64)
        for k in range(q):
            out += words[k : k + n] * f[k]
        return mix(out)

    def _keys(self, which: int, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Keys, tables x starts, of the windows at starts; a walk that passes a row's end reads padding."""
        c = self.classes[which]
        out = np.empty((self.tables, len(starts)), np.uint64)
        padded = np.append(words, np.uint64(0))
        factors = seeds(c.places.shape[1], 43) | np.uint64(1)
        for e, seed in enumerate(self.walk_seeds):
            mine = range(e * self.per_walk, (e + 1) * self.per_walk)
            sums = {t: np.zeros(len(starts), np.uint64) for t in mine}
            wanted: dict[int, list[tuple[int, int]]] = {}
            for t in mine:
                for k, p in enumerate(c.places[t]):
                    wanted.setdefault(int(p), []).append((t, k))
            at = starts.copy()
            coins = seeds(c.steps, 50) ^ seed
            for step in range(c.steps):
                word = padded[np.where(at < ends, at, len(words))]
                for t, k in wanted.get(step, ()):
                    sums[t] += word * factors[k]
                at += (mix(word ^ coins[step]) & np.uint64(1)).astype(np.int64)
            for t in mine:
                out[t] = mix(sums[t] + seeds(1, 60 + which * 1009 + t))
        return out

    def search(self, words: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, n_words, edits) of the closest stretch of each row to each item within its allowed edits.

        words: hashes of all rows one after the other; rows: n + 1 offsets.
        """
        return sorted(self._search_short(words, rows) + self._search_long(words, rows))

    def _search_short(self, words: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """The first place of each short item in each row, word for word."""
        out = []
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        for n, (table, lines, held) in self.short.items():
            slots = table.get(self._grams(words, n))
            at = np.flatnonzero(slots >= 0)
            at = at[owner[at] == owner[at + n - 1]]
            slot = slots[at]
            same = np.ones(len(at), bool)
            for k in range(n):
                same &= words[at + k] == lines[slot, k]
            at, slot = at[same], slot[same]
            _, first = np.unique(owner[at] * len(lines) + slot, return_index=True)
            out += [(int(owner[a]), item, int(a - rows[owner[a]]), n, 0) for a, x in zip(at[first], slot[first], strict=True) for item in held[x]]
        return out

    def _search_long(self, words: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        if not self.classes or len(words) < _Q:
            return []
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        grams = self._grams(words)
        hit = np.zeros(len(words), bool)
        hit[: len(grams)] = (self.gram_table.get(grams) >= 0) & (owner[: len(grams)] == owner[_Q - 1 :])
        if not hit.any():
            return []
        count = np.append(0, np.cumsum(hit))
        end_of = rows[1:][owner]
        spots: dict[tuple[int, int], list[int]] = {}
        for which, c in enumerate(self.classes):
            reach = np.minimum(np.arange(len(words)) + c.high + edits_allowed(c.high, self.rate), end_of)
            starts = np.flatnonzero(count[reach] - count[:-1] >= c.shared)
            for s in range(0, len(starts), 1 << 16):
                part = starts[s : s + (1 << 16)]
                keys = self._keys(which, words, part, end_of[part])
                got = self.key_table.get(keys.ravel()).reshape(keys.shape)
                t, k = np.nonzero(got >= 0)
                for slot, at in {(int(got[x, y]), int(part[y])) for x, y in zip(t, k, strict=True)}:
                    for item in self.owners[self.bucket[slot] : self.bucket[slot + 1]]:
                        spots.setdefault((int(owner[at]), int(item)), []).append(at)
        out = []
        for (row, item), places in sorted(spots.items()):
            n = len(self.items[item])
            most = edits_allowed(n, self.rate)
            best = None
            places.sort()
            k = 0
            while k < len(places):  # neighbouring windows are verified in one stretch
                j = k
                while j + 1 < len(places) and places[j + 1] - places[j] <= n:
                    j += 1
                a = max(int(rows[row]), places[k] - most)
                b = min(int(rows[row + 1]), places[j] + n + most)
                edits, start, end = closest(self.items[item], words[a:b])
                if edits <= most and (best is None or edits < best[2]):
                    best = (a + start - int(rows[row]), end - start, edits)
                k = j + 1
            if best is not None:
                out.append((row, item, *best))
        return out


_built: dict[tuple, BenchmarkIndex] = {}


def _blocks(spark, benchmark: DataFrame, rate: float = 0.2, recall: float = 0.99, least_words: int = 8):
    """Broadcast (ids, words) of the items in bounded blocks, each with a function that gives a worker its index."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toArrow()
        sent = spark.sparkContext.broadcast((part.column(0).to_pylist(), item_words(part.column(1))))

        def index(sent=sent, key=(sent._jbroadcast.id() if sent._jbroadcast else k, rate, recall, least_words)) -> BenchmarkIndex:
            if key not in _built:  # a worker keeps the last index between tasks
                _built.clear()
                _built[key] = BenchmarkIndex(sent.value[1], rate, recall, least_words=least_words)
            return _built[key]

        yield sent, index


def _hits(column: pa.Array, index: BenchmarkIndex) -> list[tuple[int, int, int, int, int]]:
    raw, offsets = text_buffer(column)
    rows = []
    for i, j in row_blocks(offsets):
        w = scan(LOWER[raw[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i])
        rows += [(i + r, *rest) for r, *rest in index.search(w.hashes, w.rows)]
    return rows


def find_benchmark(docs: DataFrame, benchmark: DataFrame, rate: float = 0.2, recall: float = 0.99, least_words: int = 8) -> DataFrame:
    """doc_id, item_id, start, n_words, edits: each document's stretch of words closest to each item it holds.

    An item is held if the stretch is within rate * (words of the item) word
    edits.  Documents are read whole and never shuffled.  Items go to the
    executors in blocks of at most ITEM_BLOCK, one pass over the documents for
    each block.  Items of fewer than least_words words are held only word for word, in any
    place; null ones and ones without words are not held.  Null and empty documents hold nothing;
    repeated rows are reported each; an empty table on either side gives no rows.
    """
    out = None
    for items, index in _blocks(docs.sparkSession, benchmark, rate, recall, least_words):

        def find(batches: Iterator[pa.RecordBatch], items=items, index=index) -> Iterator[pa.RecordBatch]:
            ids = items.value[0]
            for batch in batches:
                rows = [(r, ids[item], *rest) for r, item, *rest in _hits(batch.column(1), index())]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", "item_id", "start", "n_words", "edits"])

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "doc_id long, item_id long, start long, n_words long, edits long")
        out = found if out is None else out.unionByName(found)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without the rows that hold a benchmark item; every column and every other row stays.

    Rows are judged where they are read, so null and repeated doc_ids need no
    care and no text is shuffled.
    """
    at = docs.columns.index("text")
    for items, index in _blocks(docs.sparkSession, benchmark, **how):

        def keep(batches: Iterator[pa.RecordBatch], items=items, index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[row for row, *_ in _hits(batch.column(at), index())]] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
