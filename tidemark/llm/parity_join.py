"""Jaccard join of shingle sets by parity sketches and the pigeonhole principle."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .joins import spread_join
from .near_dedup import key_members, labelled, linked, texts_of
from .shared import Scratch
from .shingles import shingle_rows
from .words import mix, seeds

_SIGNED = "doc_id long, n_shingles long, print binary, bands array<long>, sketch array<long>"
#: Bits of a block's part of the sketch, from which its key is made.
_BLOCK_BITS = 12
#: Blocks that must agree beyond the one that always does; as many empty blocks may go without a key.
_SPARE = 2
#: Rounds in which pairs are chosen and checked, of which the last takes all that may be linked, and nodes of a bucket that one task compares.
_ROUNDS, _BUCKET = 2, 2048
#: Documents whose keys are made before they leave a task.
_AT_ONCE = 512
#: 64-bit words of the smallest folded sketch, and bits for each shingle of larger ones.
_FOLDED, _WIDE = 32, 4


class SizeBands:
    """Sizes cut so that the sets of a link lie in one band or in two neighbouring ones.

    Band k holds the smaller set of a link if that has more than tops[k - 1] and at most tops[k] shingles.
    ``most[k]`` is the greatest symmetric difference of such a link: with percent <= 100 I / U
    and I <= tops[k], U - I <= (100 - percent) I / percent.
    """

    def __init__(self, percent: int):
        self.percent, self.tops, self.most = percent, [], []

    def of(self, size: int) -> int:
        while not self.tops or self.tops[-1] < size:
            last = self.tops[-1] if self.tops else 0
            top = max(last + 1, last * 100 // self.percent)
            self.tops.append(top)
            self.most.append((100 - self.percent) * top // self.percent)
        return bisect.bisect_left(self.tops, size)


    def words(self, band: int) -> int:
        """Words of the folded sketch of sets of this band: a power of two, with few shingles to a bit."""
        return max(_FOLDED, 1 << max(0, _WIDE * self.tops[band] - 1).bit_length() >> 6)


def folded_sketch(items: np.ndarray, words: int) -> np.ndarray:
    """A parity sketch of 64 * words bits: an item flips one bit, so two sketches differ in at most as many bits
    as their sets have items of their own.  The halves of a sketch, combined by exclusive or, are the sketch of half as many words."""
    x = mix(items ^ seeds(1, 61)[0])
    word, bit = (x & np.uint64(words - 1)).astype(np.int64), np.uint64(1) << (x >> np.uint64(58))
    out = np.zeros(words, np.uint64)
    np.bitwise_xor.at(out, word, bit)
    return out


def block_keys(items: np.ndarray, bands: SizeBands) -> np.ndarray:
    """Keys of a set's sketch blocks in its own size band and, as a larger partner, in the band below.

    A band's sketch has most + 1 + _SPARE blocks, of which an item flips one bit.  The sketches of a link differ in at most ``most`` bits, so
    at least 1 + _SPARE blocks are equal.  Blocks without a set bit are equal in too many sets; they have keys only in a
    set with more than _SPARE of them: of two sets whose equal blocks are all empty, both are such
    sets.  Where most is 0, only equal sets are linked, and there are no keys.  A key's last five bits tell the words of
    its band's folded sketches, as a power of two.
    """
    own, out = bands.of(len(items)), []
    x = np.sort(mix(items ^ seeds(1, 51)[0]))
    high, bit = x >> np.uint64(32), x & np.uint64((1 << _BLOCK_BITS) - 1)
    for band in (own - 1, own):
        if band < 0 or not bands.most[band]:
            continue
        blocks = bands.most[band] + 1 + _SPARE
        at = (high * np.uint64(blocks)) >> np.uint64(32)  # in order, as x is
        # Equal bits cancel in an exclusive or, as in the sketch, so this hashes the block's parities.
        value = mix((at << np.uint64(_BLOCK_BITS)) + bit + np.uint64(1) + (np.uint64(band) << np.uint64(48)))
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        word = np.bitwise_xor.reduceat(value, first)
        kept, held = at[first][word != 0], word[word != 0]
        if blocks - len(kept) > _SPARE:
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), kept)
            kept, held = np.concatenate((kept, empty)), np.concatenate((held, np.zeros(len(empty), np.uint64)))
        key = mix(held + mix((kept << np.uint64(20)) + np.uint64(band) + np.uint64(7)))
        out.append(key & ~np.uint64(31) | np.uint64(bands.words(band).bit_length() - 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    """A list column of the parts, null where there is none."""
    sizes = [0 if p is None else len(p) for p in parts]
    values = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, np.uint64)]).view(np.int64)
    made = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values))
    return pc.if_else(pa.array([p is not None for p in parts]), made, pa.scalar(None, made.type))


def sign_documents(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, print, bands (keys of sketch blocks) and the folded sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = SizeBands(percent)
        for batch in (b.slice(k, _AT_ONCE) for b in batches for k in range(0, b.num_rows, _AT_ONCE)):
            size, prints, keys, sketches = [], [], [], []
            for s in shingle_rows(batch.column(1), width):
                size.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(block_keys(s, bands) if len(s) else None)
                sketches.append(folded_sketch(s, bands.words(bands.of(len(s)))) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(prints, pa.binary()), _lists(keys), _lists(sketches)], ["doc_id", "n_shingles", "print", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, _SIGNED)


def near_pairs(ids: np.ndarray, n: np.ndarray, component: np.ndarray, sketches: np.ndarray, percent: int, forest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (g, a) of a bucket's nodes of different components whose folded sketches leave a link possible.

    The Hamming distance of two sketches is a lower bound of the symmetric difference D, and sets of n and m shingles that are linked have
    D <= t (n + m), t = (100 - percent) / (100 + percent).  forest: only as many pairs as join all that such pairs join, fewer than nodes; the
    node nearest to the bits that most have is met first, so that buckets of the same copies mostly choose the same pairs.
    """
    if forest:
        held = sum(np.unpackbits(sketches[k : k + 64].view(np.uint8), axis=1).sum(0, dtype=np.int32) for k in range(0, len(ids), 64))
        common = np.packbits(2 * held > len(ids)).view(np.uint64)
        order = np.lexsort((ids, np.bitwise_count(sketches ^ common).sum(1)))
        ids, n, component, sketches = ids[order], n[order], component[order], sketches[order]
    for i in range(len(ids) - 1):
        j = i + 1 + np.flatnonzero(component[i + 1 :] != component[i])
        j = j[(100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])) & (ids[j] != ids[i])]
        far = np.bitwise_count(sketches[j] ^ sketches[i]).sum(1).astype(np.int64)
        near = (100 + percent) * far <= (100 - percent) * (n[j] + n[i])
        j = j[near]
        if not len(j):
            continue
        if forest:
            j = j[np.argsort(far[near], kind="stable")]
            j = j[np.unique(component[j], return_index=True)[1]]  # the nearest of each component
            component = np.where(np.isin(component, component[j]), component[i], component)
        yield np.full(len(j), ids[i]), ids[j]


class _Buckets:
    """Nodes that share a key, compared by their folded sketches.

    members: key, id, many; nodes: id, n_shingles and sketch.  Keys whose nodes are the same (by their number, least and
    greatest id and two sums of 40-bit hashes) and whose sketches have as many words find the same pairs, so one of them is kept.  A key's nodes
    are compared in one task up to _BUCKET; more are dealt to parts, and every two parts meet in a cell.
    """

    def __init__(self, members: DataFrame, nodes: DataFrame, percent: int, work: Scratch):
        self.percent, self.work = percent, work
        self.texts = nodes.select("id", F.col("n_shingles").alias("n"), "sketch")
        sums = [F.sum(F.shiftright(F.xxhash64("id", F.lit(k)), 24)).alias(f"sum_{k}") for k in (1, 2)]
        same = ["words", "n", "low", "high", "sum_1", "sum_2"]
        sets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), *sums).withColumn("words", F.col("key").bitwiseAND(31))
        sets = sets.groupBy(*same).agg(F.min("key").alias("key")).select("key", "n", F.ceil(F.col("n") / _BUCKET).cast("int").alias("parts"))
        self.sets = work.keep(sets, "sets")
        self.rows = work.keep(spread_join(members.select("key", "id"), self.sets, ["key"], ["id"]), "rows")

    def only(self, keys: DataFrame, name: str) -> None:
        """Go on with these keys."""
        self.sets = self.work.keep(self.sets.join(keys.hint("merge"), "key"), f"sets-{name}")
        self.rows = self.work.keep(spread_join(self.rows, self.sets.select("key", "n"), ["key"], ["id"]), f"rows-{name}")

    def pairs(self, found: DataFrame | None, forest: bool) -> DataFrame:
        """near_pairs() of all cells, as key, g, a; found: components (node, component) known so far."""
        percent = self.percent

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, held = None, []
            for batch in (*batches, None):
                out: tuple[list, list, list] = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                rows = zip(*(batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(5)), batch.column(5), strict=True) if batch is not None else [(None, 0, 0, 0, 0, None)]
                for key, cell, id_, n, component, sketch in rows:
                    if (key, cell) != last:
                        if len(held) > 1:
                            for g, a in near_pairs(*(np.array(x) for x in zip(*held, strict=True)), percent, forest):
                                for x, values in zip(out, (np.full(len(g), last[0]), g, a), strict=True):
                                    x.append(values)
                        last, held = (key, cell), []
                    if key is not None and (at := _folded_to(sketch.values.to_numpy().view(np.uint64), 1 << (key & 31))) is not None:
                        held.append((id_, n, component, at))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], ["key", "g", "a"])

        # An id with several texts enters with each; its own pairs are no links.
        rows = self.rows.join(self.texts.hint("merge"), "id")
        known = rows.join(found.select(F.col("node").alias("id"), "component").hint("merge"), "id", "left") if found is not None else rows.withColumn("component", F.lit(None).cast("long"))
        part, parts = F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts")).cast("int"), F.col("parts")
        cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda q: F.least(part, q) * parts + F.greatest(part, q))
        cells = known.select("key", F.explode(cells).alias("cell"), "id", "n", F.coalesce("component", "id").alias("component"), "sketch")
        return cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "id").mapInArrow(task, "key long, g long, a long")


def _folded_to(sketch: np.ndarray, words: int) -> np.ndarray | None:
    """A sketch of these words, or of twice as many, as one of these; others belong to no set of the band."""
    return sketch if len(sketch) == words else sketch[:words] ^ sketch[words:] if len(sketch) == 2 * words else None


def jaccard_join(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of documents linked by 100 * |A & B| >= percent * |A | B|.

    Sets are the distinct word shingles of whole texts, A-Z as a-z.

    1. Every shingle flips one bit of a sketch, so that the Hamming distance of two sketches is at most the symmetric
       difference of their sets; that of a link is bounded in each band of sizes.  Cut into more blocks than
       that bound, the sketches of a link agree in some block: equal blocks are where partners meet.  No link is missed.
    2. Sets that are equal are one node.  The nodes of equal blocks are compared by folded sketches, which rule out most pairs; of
       what is left, each bucket gives only as many pairs as would join its nodes (_Buckets).
    3. These are checked on whole sets.  Buckets of which a pair was no link are compared again, knowing the components so far, and
       give all pairs of different components that sketches leave open.

    Null, empty and blank texts have no shingles and stay alone.  Repeated doc_ids are one document if their texts agree; with
    different texts, their links count for all of them.  Null doc_ids are kept as they are, unlinked.  A very long text has keys in proportion
    to its length.  An empty table gives no rows.  Only doc_id and text are read, so other columns may have any name.
    """
    work = Scratch(docs.sparkSession, "parity")
    signed = work.keep(sign_documents(docs, width, percent), "signed")
    signed, nodes, members = key_members(signed, "signed", work, "n_shingles", "sketch")
    buckets = _Buckets(members, nodes, percent, work)
    work.drop("members")
    work.release()
    stars, found, checked, wrong, texts = None, None, None, None, None
    for k in range(1, _ROUNDS + 1):
        made = work.keep(buckets.pairs(found, k < _ROUNDS), f"made-{k}")
        work.release()
        pairs = made.select("g", "a").distinct()
        pairs = work.keep(pairs.join(checked.hint("merge"), ["g", "a"], "left_anti") if checked is not None else pairs, f"pairs-{k}")
        texts = texts_of(docs, pairs, work) if texts is None else texts  # a node that any round's pairs have is in those of the first
        links = linked(pairs, pairs.select("g", F.col("g").alias("h")).distinct(), texts, width, percent, work, f"check-{k}")
        if k == 1 or not links.isEmpty():
            found = connected_components(links if stars is None else stars.unionByName(links), work, f"components-{k}")
            stars = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        if k == _ROUNDS:
            break
        refuted = pairs.join(links.select(F.col("b").alias("g"), "a").hint("merge"), ["g", "a"], "left_anti")
        checked, wrong = (pairs, refuted) if k == 1 else (checked.unionByName(pairs), wrong.unionByName(refuted))
        buckets.only(made.join(wrong.hint("merge"), ["g", "a"], "left_semi").select("key").distinct(), f"{k}")
        if buckets.sets.isEmpty():
            break
    out = work.keep(labelled(signed, nodes, found, work), "out")
    work.drop_all_but("out")
    return out
