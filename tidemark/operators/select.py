"""Feature selection: column filters from one pass each, and wrappers around Spark ML importances."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import grouped_quantile
from .forest import fit_forest, importances_of
from .gram import pair_correlations
from .packed import Packed, packed
from .reports import long_form
from .shadows import RANK, numbered, with_shadows


def sparse_columns(df: DataFrame, columns: list[str], quantile: float) -> DataFrame:
    """column, its quantile and kept: the quantile is above zero."""
    q = grouped_quantile(long_form(df, columns), ["column"], "x", quantile, "value")
    return q.withColumn("kept", (F.col("value") > 0).cast("int"))


def distinct_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, its number of distinct values and kept: more than one."""
    d = long_form(df, columns).groupBy("column").agg(F.count_distinct("x").alias("n_distinct"))
    return d.withColumn("kept", (F.col("n_distinct") > 1).cast("int"))


def low_variance(df: DataFrame, columns: list[str], most: float) -> DataFrame:
    """column, the share of its commonest value and kept: the share is below most."""
    counts = long_form(df, columns).groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy("column").agg((F.max("n") / F.sum("n")).alias("mode_share"))
    return mode.withColumn("kept", (F.col("mode_share") < most).cast("int"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, r for each pair of columns in name order; rows with a null in the pair do not count for it.

    A constant column has null.  See gram.pair_correlations() for how wide tables are cut.
    """
    return pair_correlations(df, columns).select("a", "b", "r")


def correlated_columns(df: DataFrame, columns: list[str], most: float) -> DataFrame:
    """column and kept: no earlier column in name order has |r| above most with it, not even one itself dropped."""
    r = correlations(df, columns)
    hit = r.where(F.abs("r") > most).select(F.col("b").alias("column")).distinct().withColumn("__hit", F.lit(1))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(F.broadcast(hit), "column", "left").select("column", F.when(F.col("__hit") == 1, 0).otherwise(1).alias("kept"))


def kept(table: DataFrame) -> list[str]:
    return [r["column"] for r in table.where("kept = 1").orderBy("column").collect()]


def correlation_filter(df: DataFrame, columns: list[str], quantile: float = 1.0, mode_share: float = 1.0, r: float = 1.0) -> list[str]:
    """The filters in a row: sparse, constant, low variance, correlated; one with a threshold of 1 is off."""
    left = list(columns)
    if quantile < 1:
        left = kept(sparse_columns(df, left, quantile))
    left = kept(distinct_columns(df, left))
    if mode_share < 1:
        left = kept(low_variance(df, left, mode_share))
    return kept(correlated_columns(df, left, r)) if r < 1 and len(left) > 1 else left


def importances(df: DataFrame | Packed, columns: list[str], target: str, classifier) -> list[float]:
    """Importances of the columns in a fit of a boosted or forest classifier; forests read packed rows, or pack df's."""
    if isinstance(classifier, RandomForestClassifier):
        table = df if isinstance(df, Packed) else packed(df, columns, target)
        try:
            return importances_of(fit_forest(table, columns, classifier.getNumTrees(), classifier.getMaxDepth(), classifier.getSeed()), len(columns))
        finally:
            if table is not df:
                table.unpersist()
    rows = df.na.fill(0.0, columns).select(*columns, F.col(target).cast("double").alias(target)).persist()  # a fit passes over it many times
    try:
        vectors = VectorAssembler(inputCols=columns, outputCol="__x", handleInvalid="keep").transform(rows).select("__x", target)
        return classifier.setFeaturesCol("__x").setLabelCol(target).fit(vectors).featureImportances.toArray().tolist()
    finally:
        rows.unpersist()


def shadow_select(df: DataFrame, columns: list[str], target: str, cutoff: float = 1.0, delta: float = 0.1, rounds: int = 4, trees: int = 10, seed: int = 7) -> list[str]:
    """Columns whose boosted-tree importance beats cutoff * the best shadow's, round after round.

    The cutoff halves when none survives (five tries); rounds end when less than a share of delta goes.
    """
    left = list(columns)
    all_rows = numbered(df.select(*left, target), RANK)
    for k in range(rounds):
        rows, shadows = with_shadows(all_rows.select(*left, target, RANK), left, seed + k)
        imp = importances(rows, [*left, *shadows], target, GBTClassifier(maxIter=trees, maxDepth=4, seed=seed))
        real, best = imp[: len(left)], max(imp[len(left) :])
        level, chosen = cutoff, []
        for _ in range(5):
            chosen = [c for c, v in zip(left, real, strict=True) if v > level * best]
            if chosen:
                break
            level /= 2
        if not chosen:
            return left
        gone = 1 - len(chosen) / len(left)
        left = chosen
        if gone < delta:
            break
    return left


def boruta(df: DataFrame, columns: list[str], target: str, rounds: int = 20, trees: int = 20, depth: int = 5, alpha: float = 0.05, seed: int = 7) -> DataFrame:
    """column, hits, rounds, decision: how often a column's random-forest importance beat the best shadow's.

    After each round, a column whose hits are too many for chance (a fair coin; one-sided, alpha shared among all columns) is
    confirmed, one with too few is rejected and leaves the next rounds; rounds end when all are decided.  The
    rest is tentative.  An undecided column needs log2(columns / alpha) rounds at least.
    """
    hits, played, decision = dict.fromkeys(columns, 0), dict.fromkeys(columns, 0), {}
    level = alpha / max(1, len(columns))
    table = packed(df, columns, target)  # once: a shadow has its column's bins
    for k in range(rounds):
        left = [c for c in columns if decision.get(c) != "rejected"]
        if not left or all(c in decision for c in left):
            break
        rows, shadows = with_shadows(table, left, seed + k)
        imp = importances(rows, [*left, *shadows], target, RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed + k))
        rows.unpersist()
        best = max(imp[len(left) :])
        for c, v in zip(left, imp, strict=False):
            if c in decision:
                continue
            hits[c] += v > best
            played[c] += 1
            n, h = played[c], hits[c]
            if sum(math.comb(n, j) for j in range(h, n + 1)) < level * 2**n:
                decision[c] = "confirmed"
            elif sum(math.comb(n, j) for j in range(h + 1)) < level * 2**n:
                decision[c] = "rejected"
    table.unpersist()
    made = [(c, int(hits[c]), played[c], decision.get(c, "tentative")) for c in columns]
    return df.sparkSession.createDataFrame(made, "column string, hits int, rounds int, decision string")


def boruta_select(df: DataFrame, columns: list[str], target: str, **how) -> list[str]:
    """The columns that boruta() confirms."""
    sure = {r["column"] for r in boruta(df, columns, target, **how).where("decision = 'confirmed'").collect()}
    return [c for c in columns if c in sure]


def eliminate(df: DataFrame, columns: list[str], target: str, keep: int, step: int = 1, trees: int = 20, seed: int = 7) -> list[str]:
    """Recursive elimination: drop the step least important columns of a random forest until keep are left."""
    left = list(columns)
    if len(left) <= keep:
        return left
    rows = packed(df, columns, target)  # once for all rounds
    while len(left) > keep:
        imp = importances(rows, left, target, RandomForestClassifier(numTrees=trees, maxDepth=5, seed=seed))
        out = sorted(range(len(left)), key=lambda k: (imp[k], left[k]))[: min(step, len(left) - keep)]
        left = [c for k, c in enumerate(left) if k not in out]
    rows.unpersist()
    return left


def project(parts: dict[str, DataFrame], fit_on: str, chooser: Callable[[DataFrame], list[str]], keys: list[str]) -> dict[str, DataFrame]:
    """Choose columns on one part (the training rows) and project all parts to them and the keys."""
    names = chooser(parts[fit_on])
    return {k: v.select(*keys, *names) for k, v in parts.items()}
