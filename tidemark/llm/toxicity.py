"""Toxicity of documents: noisy-channel deobfuscation, then a score of the restored text.

Writers hide words by leetspeak, by spacing letters out and by repeating them.
A hidden word is a lattice: each character may stand for several letters, for
one of a run, or for nothing.  Viterbi finds the path that a character language
model of the whole corpus and the channel's costs like best.  The restored text
is scored by the words and word beginnings that labelled documents teach.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, Table64, byte_class, mix, row_blocks, scan, seeds, text_buffer

#: Symbols of the language model: 0 for all that is not a letter, a-z, the small letters of Latin-1, 63 for other letters.
SYMBOLS = 64
_LATIN = [c for c in range(0xDF, 0x100) if c != 0xF7]
_SYMBOL = {chr(97 + k): 1 + k for k in range(26)} | {chr(c): 27 + k for k, c in enumerate(_LATIN)}
_LUT = np.zeros(0x250, np.uint8)
for _c in range(0x250):
    _low = chr(_c).lower()
    _LUT[_c] = _SYMBOL.get(_low, 63 if _low.isalpha() else 0)

# What a character of leetspeak may stand for, and look-alikes of Latin letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou"}
LOOKALIKE = str.maketrans("аеорсухіјѕԁɡαοερκν", "aeopcyxijsdgaoepkv")
_DROP = ".-_*'`~·​‌‍­⁠"

#: Tokens that have a character besides letters in or at them, or one letter three times; doubled letters are found by the model.
_HINT = re.compile(
    r"[^\W\d_][0-9@$!|+(*#€£._\-~·​-‍­⁠]+[^\W\d_]"  # a letter, something odd, a letter
    r"|[^\W\d_][0-9@$|+*#€£]"
    r"|[0-9@$|+*#€£][^\W\d_]"
    r"|(?<!\S)!+[^\W\d_]"
    r"|([^\W\d_])\1\1"  # a letter three times
    r"|(?<![^\W_])[^\W_](?:[^\w\s]+[^\W_](?![^\W_])){2,}"  # single characters with marks between
    r"|[а-ћɡαοερκν]"
    r"|(?<!\S)\S(?:\s{1,2}\S){2,}(?!\S)"  # single characters with spaces between
    r"|(?<!\S)[0-9]*[@$|+*#€£][0-9@$!|+*#€£]*(?!\S)",  # symbols alone
    re.I,
)
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,2}\S){2,}(?!\S)")
_SPACES = re.compile(r"\s+")
_NUMBER = re.compile(r"[\d.,:;/%+\-]+")
_TOKEN = re.compile(r"\S+")
#: What opens and closes a token without belonging to it, and symbols that junk hangs onto words in runs.
_HEAD, _TAIL, _RUNS = "\"'([{<", "!?.,;:\"')]}>|", "#$%&*@+"


@dataclass(frozen=True)
class CharModel:
    """Log probabilities of a symbol after the two before it."""

    logp: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> "CharModel":
        """counts: SYMBOLS**3 trigram counts; interpolated down to the uniform distribution."""
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 8 * p1) / (two.sum(axis=1, keepdims=True) + 8)
        p3 = (three + 8 * p2[None]) / (three.sum(axis=2, keepdims=True) + 8)
        return CharModel(np.log(p3))


def trigram_counts(column: pa.Array) -> np.ndarray:
    """SYMBOLS**3 counts of symbol trigrams over whole texts; rows are apart."""
    total = np.zeros(SYMBOLS**3, np.int64)
    _, offsets = text_buffer(column)
    for i, j in row_blocks(offsets):
        line = "\n\n".join(t or "" for t in column.slice(i, j - i).to_pylist())
        code = np.frombuffer(f"\n\n{line}\n\n".encode("utf-32-le"), np.uint32)
        s = np.where(code < len(_LUT), _LUT[np.minimum(code, len(_LUT) - 1)], np.uint8(63)).astype(np.int64)
        total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    total[0] = 0  # runs of what is not a letter say nothing
    return total


def corpus_model(docs: DataFrame) -> CharModel:
    """The language model of all rows; the driver gets SYMBOLS**3 sums at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            total += trigram_counts(batch.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    sums = docs.select("text").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**3, np.int64)
    counts[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return CharModel.of(counts)


#: Costs of the channel: a letter for a symbol, one letter for a run of symbols, a letter written twice, a symbol written
#: between letters, one of leetspeak that stands for nothing, a mark or symbol that stands for itself.
_SWAP, _ONE, _TWICE, _BETWEEN, _NOTHING, _MARK, _ITSELF = 1.0, 12.0, 5.5, 0.8, 6.5, 0.5, 9.0


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character what it may be, with the channel's cost; a blank may also be a word's end."""
    out: list[list[tuple[str, float]]] = []
    k = 0
    while k < len(token):
        c = token[k]
        n = 1
        while k + n < len(token) and token[k + n] == c:
            n += 1
        if c == " ":
            out.append([("", 0.0), (" ", 3.0)])
        elif c.isalpha():
            out.append([(c, 0.0)] if n == 1 else [(c, _TWICE), (c * 2, 0.0)] if n == 2 else [(c, 0.5), (c * 2, 0.7)])
        else:
            leet = LEET.get(c, "")
            options = [(x, _SWAP if n == 1 else _ONE) for x in leet]
            options += [(x * 2, _SWAP + 0.2) for x in leet if n == 2]
            if c in _DROP or not leet:
                options += [("", _BETWEEN), (c * n, _MARK)]
            else:
                options += [("", _NOTHING * n)] if not c.isdigit() else []
                options += [(c * n, _ITSELF * n)]
            out.append(options)
        k += n
    return out


def _symbol(ch: str) -> int:
    return _SYMBOL.get(ch, 63 if ch.isalpha() else 0)


def restore(token: str, model: CharModel) -> str:
    """The likeliest plain form of an obfuscated token: Viterbi over its lattice.

    A state is the last two symbols; its best path is a chain of back links, so
    the work is linear in the token.
    """
    logp = model.logp
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in _lattice(token):
        then: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            for letters, extra in options:
                x, y, total = a, b, cost + extra
                for ch in letters:
                    s = _symbol(ch)
                    if s or y:  # several characters that are no letters end a word once
                        total -= logp[x, y, s]
                        x, y = y, s
                if (x, y) not in then or total < then[x, y][0]:
                    then[x, y] = (total, (path, letters))
        best = then
    path = min(((cost - (logp[a, b, 0] if b else 0.0), k, path) for k, ((a, b), (cost, path)) in enumerate(best.items())))[2]
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


class Restorer:
    """Restores obfuscated tokens of texts; the answers for tokens seen before are kept, up to a bound."""

    def __init__(self, model: CharModel, most: int = 200_000):
        self.model, self.most, self.known = model, most, {}
        # A doubled letter x between p and n costs what its second one and n after two of them cost more than n after
        # one does.  Both choices leave the rest of a token alike, so Viterbi takes one letter exactly where that is above
        # the channel's cost: only such tokens need a lattice for their doubled letters.
        cost = -model.logp
        x = np.arange(SYMBOLS)
        gain = cost[:, x, x][:, :, None] + cost[x, x, :][None] - cost
        self.doubtful = gain > _TWICE
        self.doubtful[:, 0] = False

    def _token(self, token: str) -> str:
        if token not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[token] = restore(token, self.model)
        return self.known[token]

    def _word(self, word: str) -> str:
        core = word.lstrip(_HEAD)
        head = word[: len(word) - len(core)]
        core = core.rstrip(_TAIL)
        if len(core) > 3 and core[-1] in _RUNS and core[-3:] == core[-1] * 3:
            core = core.rstrip(core[-1])
        tail = word[len(head) + len(core) :]
        low = unicodedata.normalize("NFKC", core).lower().translate(LOOKALIKE)
        if not low or _NUMBER.fullmatch(low):
            return word
        return head + self._token(low) + tail

    def _doubles(self, text: str) -> list[int]:
        """Places of doubled letters that the model takes for one."""
        code = np.frombuffer(f" {text}  ".encode("utf-32-le", "replace"), np.uint32)
        s = np.where(code < len(_LUT), _LUT[np.minimum(code, len(_LUT) - 1)], np.uint8(63))
        return np.flatnonzero((s[1:-2] == s[2:-1]) & self.doubtful[s[:-3], s[1:-2], s[3:]]).tolist()

    def __call__(self, text: str) -> str:
        """The text with every suspicious token restored; the same object where there is none."""
        places = self._doubles(text)
        places += [m.start() for m in _HINT.finditer(text)]
        if not places:
            return text
        out, at = [], 0
        for place in sorted(places):
            if place < at:
                continue
            if spaced := _SPACED.match(text, place):
                a, b = spaced.span()
                plain = self._token(_SPACES.sub(" ", unicodedata.normalize("NFKC", text[a:b]).lower()).translate(LOOKALIKE))
            else:
                a = place
                while a > at and not text[a - 1].isspace():
                    a -= 1
                b = _TOKEN.match(text, place).end()
                plain = self._word(text[a:b])
            out += [text[at:a], plain]
            at = b
        return "".join(out) + text[at:]


_NOT_LETTERS = byte_class(bytes(x for x in range(128) if not chr(x).isalpha()))
#: Lengths in bytes of the word beginnings that are features beside whole words.
_HEADS = (3, 4, 5, 6, 7, 8)


def text_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For blocks of rows: first row, how many, and for each feature its row in the block and its hash (with repeats).

    Features of a text are its words, in small letters, and their beginnings.
    """
    raw, offsets = text_buffer(column)
    powers = seeds(max(_HEADS), 71) | np.uint64(1)
    salts = seeds(max(_HEADS) + 1, 72)
    values = seeds(256, 73)
    for i, j in row_blocks(offsets):
        block = LOWER[raw[offsets[i] : offsets[j]]]
        wide = np.zeros(len(block), bool)
        wide[1:] = (block[:-1] == 0xC3) & (block[1:] >= 0x80) & (block[1:] <= 0x9E) & (block[1:] != 0x97)
        block = block + (wide.astype(np.uint8) << 5)
        words = scan(block, offsets[i : j + 1] - offsets[i], _NOT_LETTERS)
        owner = np.repeat(np.arange(j - i), np.diff(words.rows))
        size = words.ends - words.starts
        some = size >= 3
        rows, hashes = [owner[some]], [words.hashes[some]]
        total = np.zeros(len(owner), np.uint64)
        for k in range(max(_HEADS)):
            live = np.flatnonzero(size > k)
            total[live] += values[block[words.starts[live] + k]] * powers[k]
            if k + 1 in _HEADS:
                rows.append(owner[live])
                hashes.append(mix(total[live] ^ salts[k + 1]))
        yield i, j - i, np.concatenate(rows), np.concatenate(hashes)


def distinct_features(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[keep], h[keep]


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, n: int, penalty: float = 0.2, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept over n binary features, by accelerated gradient steps on the penalised loss."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(n), 0.0
    vw, vb = w, b
    longest = max((len(r) for r in rows), default=0) + 1
    rate = 1 / (0.25 * longest * max(1, len(rows)) / 8 + penalty)
    last = math.inf
    for t in range(steps):
        z = np.bincount(owner, vw[flat], len(rows)) + vb
        q = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        gw = np.bincount(flat, (q - y)[owner], n) + penalty * vw
        gb = (q - y).sum()
        nw, nb = vw - rate * gw, vb - rate * gb
        loss = -(y * np.log(q + 1e-12) + (1 - y) * np.log(1 - q + 1e-12)).sum() + penalty / 2 * (vw @ vw)
        if loss > last:
            rate /= 2
        last = loss
        vw, vb = nw + t / (t + 3) * (nw - w), nb + t / (t + 3) * (nb - b)
        w, b = nw, nb
    return w, float(b)


@dataclass(frozen=True)
class ToxicityModel:
    """The character model, the chosen features and their weights."""

    chars: CharModel
    features: np.ndarray
    weights: np.ndarray
    intercept: float


def restored_column(column: pa.Array, restorer: Restorer) -> pa.Array:
    return pa.array([restorer(t or "") for t in column.to_pylist()], pa.string())


def _chosen_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, doc_id and label of at most ``most`` toxic and as many other labelled rows, by a hash of doc_id; one row of a repeated doc_id."""
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = 4000, features: int = 1500, least: int = 4) -> ToxicityModel:
    """Learn from all texts (character model) and from at most ``most`` labelled rows of each kind.

    Features are counted by Spark over the chosen rows, distinct in each; the
    ``features`` most telling by likelihood ratio, in ``least`` toxic rows at least, get weights.  Without
    rows of both kinds every score is the share of toxic labels (0 without labels).
    """
    from .shared import Scratch

    spark = docs.sparkSession
    chars = corpus_model(docs)
    known = {r["label"]: r["count"] for r in labels.where("toxic is not null").groupBy(F.col("toxic").cast("int").alias("label")).count().collect()}
    share = known.get(1, 0) / max(1, sum(known.values()))
    none = ToxicityModel(chars, np.zeros(0, np.uint64), np.zeros(0), math.log((share + 1e-4) / (1 - share + 1e-4)))
    if not known.get(0) or not known.get(1):
        return none
    sent = spark.sparkContext.broadcast(chars)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), restored_column(batch.column(2), restorer)], ["doc_id", "label", "text"])

    chosen = Scratch(spark, "toxic").keep(_chosen_rows(docs, labels, most).select("doc_id", "label", "text").mapInArrow(plain, "doc_id long, label int, text string"), "chosen")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy()
            for i, _, rows, hashes in text_features(batch.column(1)):
                rows, hashes = distinct_features(rows, hashes)
                value, where = np.unique(hashes, return_inverse=True)
                pos = np.bincount(where, y[i + rows] == 1, len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(pos), pa.array(np.bincount(where, minlength=len(value)) - pos)], ["feature", "pos", "neg"])

    many = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    p, n = many.get(1, 0), many.get(0, 0)
    if not p or not n:
        return none

    def part(k, e):  # k * log(k / e), 0 for k = 0
        return F.when(k > 0, k * F.log(k / e)).otherwise(0.0)

    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    both, all_ = pos + neg, float(p + n)
    ratio = part(pos, both * p / all_) + part(neg, both * n / all_) + part(p - pos, (all_ - both) * p / all_ + 1e-9) + part(n - neg, (all_ - both) * n / all_ + 1e-9)
    counts = chosen.select("label", "text").mapInArrow(count, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    top = counts.where((F.col("pos") >= least) & (pos * n > neg * p)).withColumn("ratio", ratio).orderBy(F.desc("ratio"), "feature").limit(features).collect()
    picked = np.array([r["feature"] for r in top], np.int64).view(np.uint64)
    if not len(picked):
        return none

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(picked)
        for batch in batches:
            got = pa.array(find(batch.column(1)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), got], ["label", "at"])

    rows = chosen.select("label", "text").mapInArrow(seen, "label int, at array<long>").collect()
    rows.sort(key=lambda r: (r["label"], r["at"]))
    weights, intercept = fit_logistic([np.array(r["at"], np.int64) for r in rows], np.array([r["label"] for r in rows], float), len(picked))
    # The chosen rows are not in the labels' proportion; the intercept is moved to it.
    intercept += math.log(share / (1 - share)) - math.log(p / n)
    return ToxicityModel(chars, picked, weights, intercept)


def _finder(picked: np.ndarray):
    """A function from a text column to the ascending indexes of the picked features in each row."""
    table = Table64(12, 24)
    table.put(picked, np.arange(len(picked)))

    def find(column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, many, rows, hashes in text_features(column):
            at = table.get(hashes)
            hit = at >= 0
            r, h = distinct_features(rows[hit], at[hit])
            out += np.split(h.astype(np.int64), np.searchsorted(r, np.arange(1, many)))
        return out

    return find


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic) of every whole text, restored first.

    Null texts score like empty ones; repeated rows and null ids stay; an empty table gives no rows.  Only doc_id and
    text are read, so other columns may have any name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        restorer, find = Restorer(m.chars), _finder(m.features)
        for batch in batches:
            z = np.array([m.weights[at].sum() + m.intercept for at in find(restored_column(batch.column(1), restorer))], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")
