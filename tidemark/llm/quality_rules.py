"""Learned decision lists for document quality, as ordered Spark conditional expressions.

Native: statistics and verdicts are built-in SQL functions over each row; no
shuffle, no Python on the executors.  The list is learned by sequential
covering: grow a conjunction of thresholds on some labelled rows, prune it on
others, set aside what it covers, and go on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word characters are all but these; symbols of the base statistics.
_SPACE = r"\x20\x09-\x0D"
_SYMBOL = r"[#*$%&|<>]"

#: What rules may test: shares that do not depend on a text's length, and its length.
FEATURES = ("words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share", "digit_share")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the other counts that rules use.

    Counts are over the whole text; null counts as empty and gives zeros.
    n_dup_lines: lines with a word that equal an earlier line.  n_repeat_words:
    words inside 3-word windows that occur twice or more in the text.  Windows are
    compared by 64-bit hashes; only texts that repeat one pay for sorting.
    Helper columns start with ``__q`` and do not clash with those of docs.
    """
    t, w, h = F.col("__q_text"), F.col("__q_words"), F.col("__q_windows")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{_SPACE}]"))
    out = docs.withColumn("__q_text", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({"__q_words": F.regexp_extract_all(t, F.lit(f"[^{_SPACE}]+"), F.lit(0)), "__q_lines": lines})
    n = F.size(w)
    window = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))
    out = out.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_distinct": F.size(F.array_distinct(w)).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(_SYMBOL)).cast("long"),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "n_marks": F.regexp_count(t, F.lit(r"[!?]")).cast("long"),
        "n_digits": F.regexp_count(t, F.lit(r"[0-9]")).cast("long"),
        "n_lines": F.size("__q_lines").cast("long"),
        "n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
        "__q_windows": F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")),
    })
    # Windows in order of hash; those equal to a neighbour repeat, and their places come back in order.
    by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn("__q_sorted", F.when(F.size(F.array_distinct(h)) < F.size(h), by_hash))
    s = F.col("__q_sorted")

    def twice(x: Column, k: Column) -> Column:
        return ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

    out = out.withColumn("__q_places", F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"])))
    p = F.col("__q_places")
    covered = F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(3), lambda acc, k: acc + F.least(F.lit(3), F.get(p, k) - F.get(p, k - 1)))
    repeats = F.when(p.isNull(), 0).when(F.size(p) == 1, 3).otherwise(covered)
    # The id is what a filter on the statistics can name so that Spark leaves it above them: pushed
    # below, it would hold copies of every expression here.
    return out.withColumns({"n_repeat_words": repeats.cast("long"), "__q_id": F.monotonically_increasing_id()}).drop("__q_text", "__q_words", "__q_lines", "__q_windows", "__q_sorted", "__q_places")


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_features() -> dict[str, Column]:
    """FEATURES from the counts of text_statistics()."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    values = (F.col("n_words").cast("double"), F.col("word_chars") / words, F.col("n_symbols") / words, F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words, F.col("n_distinct") / words, F.col("n_upper") / chars, F.col("n_marks") / words, F.col("n_digits") / chars)
    return dict(zip(FEATURES, values, strict=True))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, ">" or "<=", threshold); a row that meets all is rejected."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, at in self.tests:
            out = out & (features[name] > at if sign == ">" else features[name] <= at)
        return out

    def covers(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, sign, at in self.tests:
            v = x[:, FEATURES.index(name)]
            out &= v > at if sign == ">" else v <= at
        return out


def _cuts(v: np.ndarray, most: int) -> np.ndarray:
    u = np.unique(v)
    mid = (u[1:] + u[:-1]) / 2
    return mid if len(mid) <= most else np.unique(np.quantile(mid, np.linspace(0, 1, most)))


def _grow(x, bad, literals: int, cuts: int) -> Rule:
    tests, inside = [], np.ones(len(x), bool)
    while len(tests) < literals and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for f, name in enumerate(FEATURES):
            v, b = x[inside, f], bad[inside]
            at = _cuts(v[b], cuts) if b.any() else v[:0]
            order = np.argsort(v, kind="stable")
            cum = np.append(0, np.cumsum(b[order]))
            k = np.searchsorted(v[order], at, "right")
            for sign, p, n in (("<=", cum[k], k - cum[k]), (">", p0 - cum[k], n0 - (k - cum[k]))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0.0)
                if len(g) and g.max() > gain:
                    best, gain = (name, sign, float(at[int(g.argmax())])), g.max()
        if best is None:
            break
        tests.append(best)
        inside &= Rule((best,)).covers(x)
    return Rule(tuple(tests))


def _worth(rule: Rule, x, bad) -> tuple[float, int]:
    hit = rule.covers(x)
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return (p + 1) / (p + n + 2), p


def learn_decision_list(x: np.ndarray, bad: np.ndarray, prune_on: np.ndarray, precision: float = 0.97, least: int = 3, rules: int = 12, literals: int = 4, cuts: int = 64) -> list[Rule]:
    """Sequential covering of the bad rows of x (columns: FEATURES).

    prune_on: the rows that prune and accept a rule; the others grow it.  A
    rule is kept while at least ``least`` bad rows of the pruning set meet it with
    (Laplace) precision of at least ``precision``, so few good documents are lost.
    """
    found: list[Rule] = []
    open_ = np.ones(len(x), bool)
    while len(found) < rules:
        grow, prune = open_ & ~prune_on, open_ & prune_on
        if not (grow & bad).any():
            break
        rule = _grow(x[grow], bad[grow], literals, cuts)
        shorter = [Rule(rule.tests[:k]) for k in range(1, len(rule.tests) + 1)]
        if not shorter:
            break
        rule = max(shorter, key=lambda r: (round(_worth(r, x[prune], bad[prune])[0], 3), -len(r.tests)))
        good, hits = _worth(rule, x[prune], bad[prune])
        if good < min(precision, (hits + 1) / (hits + 2)) or hits < least:
            break
        found.append(rule)
        open_ &= ~rule.covers(x)
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """Text, doc_id and label of at most ``most`` labelled rows, chosen by a hash of doc_id.

    The chosen labels have a fixed bound, and so may be broadcast to the documents.  A doc_id with several rows gives
    one, with the least of its texts.
    """
    chosen = labels.where(f"{target} is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit_rules(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> list[Rule]:
    """Learn a list from at most ``most`` labelled documents; a third of them, by CRC of the id, prune.

    Without labels of both kinds the list is empty and only the base test rejects.
    """
    rows = text_statistics(labelled_sample(docs, labels, "quality", most)).select("label", (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("prune"), *(v.alias(k) for k, v in rule_features().items())).collect()
    if not rows:
        return []
    data = np.array(rows, float)
    data = data[np.lexsort(data.T)]
    return learn_decision_list(data[:, 2:], data[:, 0] == 0, data[:, 1] == 1)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (1.. for the first rule met, else 0) and kept."""
    features = rule_features()
    which = F.lit(0)
    for k in range(len(rules), 0, -1):
        which = F.when(rules[k - 1].column(features), k).otherwise(which)
    return stats.withColumns({"base_failed": base_failed(), "rule": which}).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """doc_id with statistics, base_failed, rule and kept for every row, in one pass without a shuffle.

    Other columns of docs are not read, so their names cannot clash.  Null and
    empty texts have no words and fail the base test; repeated rows and null ids stay; an
    empty table gives no rows.
    """
    return judge(text_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), fit_rules(docs, labels, most)).drop("text", "__q_id")


def keep_by_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of docs, with their own columns, that pass the base test and the rules."""
    rows = docs.select(F.struct(*docs.columns).alias("__q_row"), F.col("text"))
    return judge(text_statistics(rows), rules).where((F.col("__q_id") >= 0) & F.col("kept")).select("__q_row.*")
