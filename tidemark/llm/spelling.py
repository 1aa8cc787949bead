"""Spelling variants of a corpus's words, found in wildcard groups without making pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch
from .words import mix, row_blocks, seeds, text_buffer

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "[a-zÀ-ÿ]+"
#: What a key stands for: a word, a word without one code point, a word with one code point left open.
_WORD, _SHORTER, _OPEN = 0, 1, 2
#: Bytes of words whose keys are made at once.
_AT_ONCE = 1 << 18
_KEYS = "a long, b long, rank long, kind int"


def count_words(docs: DataFrame, noise: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """word, n: runs of Latin letters in all texts, A-Z as a-z, that are long and frequent enough.

    Where ``noise`` divides the CRC-32 of "doc_id:run", the run loses one code point.  Counts are
    combined map-side, so a frequent word is no hot key.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(_RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length)
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    runs = runs.withColumn("h", h).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    less = F.concat(F.substring("run", 1, F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _word_keys(column: pa.Array, ranks: np.ndarray, shortest: int) -> Iterator[pa.RecordBatch]:
    """The keys of each word: its own, of each string with one code point less, of each with one left open.

    A string's hash is a sum of scrambled (code point, position) values, so that all keys of a word come from
    prefix sums: work and memory follow its length.  Keys have 128 bits.
    """
    raw, offsets = text_buffer(column)
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    for i, j in row_blocks(offsets, _AT_ONCE):
        points = np.frombuffer(raw[offsets[i] : offsets[j]].tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = lengths[i:j]
        first = np.concatenate(([0], np.cumsum(n)))
        row = np.repeat(np.arange(j - i), n)
        at = np.arange(len(points)) - first[row]
        again = np.zeros(len(points), bool)  # leaving out either of two equal neighbours gives the same string
        again[1:] = (points[1:] == points[:-1]) & (at[1:] > 0)
        cut = ~again & (n[row] > shortest)
        keys = []
        for salt in (41, 42):
            s = seeds(4, salt)
            here, moved = (mix((points << np.uint64(40)) + p.astype(np.uint64) * s[0] + s[1]) for p in (at, at - 1))
            up, up_moved = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64))) for x in (here, moved))
            whole = up[first[1:]] - up[first[:-1]]
            before = up[:-1] - up[first[:-1]][row]
            after = up_moved[first[1:]][row] - up_moved[1:]
            size = n.astype(np.uint64)
            word = mix(whole + mix(size * s[2]))
            shorter = mix(before + after + mix((size[row] - np.uint64(1)) * s[2]))[cut]
            free = mix(whole[row] - here + mix((size[row] << np.uint64(32)) + at.astype(np.uint64) + s[3]))
            keys.append(np.concatenate((word, shorter, free)).view(np.int64))
        own = ranks[i:j]
        kinds = np.repeat(np.array([_WORD, _SHORTER, _OPEN], np.int32), [j - i, int(cut.sum()), len(points)])
        yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(np.concatenate((own, own[row[cut]], own[row]))), pa.array(kinds)], ["a", "b", "rank", "kind"])


def _neighbours(words: DataFrame, least_length: int) -> DataFrame:
    """rank, n_near, best: how many near words a word has, and the least rank among them.

    One shuffle of the keys.  A key's rows are at most one word, the words that become it by losing a
    code point, or the words that are equal but for one position: never more than the alphabet
    allows.  A group gives its size and its two first ranks, a row takes the first that is not its own, and
    rows of groups without a second row go at once.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _word_keys(batch.column(1), batch.column(0).to_numpy(), least_length)

    keys = words.select("rank", "word").mapInArrow(keyed, _KEYS)
    group = Window.partitionBy("a", "b").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def ranks(kind: int) -> Column:
        return F.when(F.col("kind") == kind, F.col("rank"))

    seen = keys.withColumns(
        {
            "word": F.max(ranks(_WORD)).over(group),
            "shorter": F.min(ranks(_SHORTER)).over(group),
            "n_shorter": F.count(ranks(_SHORTER)).over(group),
            "n_open": F.count(ranks(_OPEN)).over(group),
            "first": F.min(ranks(_OPEN)).over(group),
            "second": F.nth_value(ranks(_OPEN), 2, True).over(group),
        }
    )
    kind = F.col("kind")
    near = F.when(kind == _WORD, F.col("n_shorter")).when(kind == _SHORTER, F.col("word").isNotNull().cast("long")).otherwise(F.col("n_open") - 1)
    best = F.when(kind == _WORD, F.col("shorter")).when(kind == _SHORTER, F.col("word")).when(F.col("rank") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    found = seen.select("rank", near.alias("near"), best.alias("best")).where("near > 0")
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame, work: Scratch) -> DataFrame:
    """rank, to: the last word that each word's forms lead to.

    A form is at least twice as frequent as its word, so a chain has at most 63 steps, and each round doubles the
    distance that a row has covered.
    """
    links = work.keep(links, "roots-0")
    for k in range(1, 8):
        ahead = links.select(F.col("rank").alias("to"), F.col("to").alias("further"))
        jumped = links.join(ahead, "to", "left").select("rank", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved"))
        jumped = work.keep(jumped, f"roots-{k}")
        work.drop(f"roots-{k - 1}")
        links = jumped.select("rank", "to")
        if jumped.where("moved").isEmpty():
            break
    return links


def spelling_variants(docs: DataFrame, noise: int = 97, least_length: int = 5, least_count: int = 3, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for every long and frequent word of the corpus.

    Two words are near if they differ by one inserted, deleted or replaced code point.  A word's form is the most
    frequent near word (ties: the smallest in code-point order), if that is at least ``factor`` times as
    frequent; its root is where forms lead to.

    Replacements meet in groups of (position, prefix, suffix), which keep their size and their two first
    words; a string with one code point less meets the word that it is.  No pair of words is ever made.  Words travel as
    ranks by frequency and code points, keys as 128-bit hashes: very long words cost their length, not its square.

    Null and empty texts have no words; a null doc_id counts as an empty one in the CRC-32; a repeated row counts again.  An empty table gives no
    rows.  Only doc_id and text are read, so other columns may have any name.
    """
    work = Scratch(docs.sparkSession, "spelling")
    counted = count_words(docs, noise, least_length, least_count)
    # Sorted by ranges, so these ids rise in the wanted order; they are fixed once written.
    words = work.keep(counted.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("rank"), "word", "n"), "words")
    near = work.keep(_neighbours(words, least_length), "near")
    forms = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    rows = words.join(near, "rank", "left").join(forms, "best", "left")
    good = F.coalesce(F.col("form_n") >= factor * F.col("n"), F.lit(False))
    rows = rows.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *(F.when(good, F.col(c)).alias(c) for c in ("best", "form", "form_n")))
    rows = work.keep(rows, "rows")
    work.drop("near")
    to = _roots(rows.where("best is not null").select("rank", F.col("best").alias("to")), work)
    ends = words.select(F.col("rank").alias("to"), F.col("word").alias("root"))
    out = rows.join(to.join(ends, "to").select("rank", "root"), "rank", "left")
    out = work.keep(out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "out")
    work.drop_all_but("out")
    return out
