"""Classifier metrics, lift and distribution distances, as aggregations and bucketed cumulative sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prefix import cumulative, row_numbers
from ..sources.stored import stored


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def classifier_metrics(df: DataFrame, label: str, probability: str, threshold: float = 0.5) -> DataFrame:
    """One row: counts, accuracy, precision, recall, f1, the rates and 1 - Brier; one pass."""
    y, hit = F.col(label) == 1, F.col(probability) >= threshold
    row = df.agg(
        F.count_if(y & hit).alias("tp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(~y & ~hit).alias("tn"),
        F.count_if(y & ~hit).alias("fn"),
        (1 - F.avg((F.col(probability) - F.col(label)) * (F.col(probability) - F.col(label)))).alias("brier_complement"),
    )

    def share(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return row.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + tn + fn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
            "true_negative_rate": share(tn, tn + fp),
            "false_positive_complement": 1 - share(fp, tn + fp),
            "false_negative_complement": 1 - share(fn, tp + fn),
        }
    )


def classifier_report(test: DataFrame, train: DataFrame, label: str, probability: str, threshold: float = 0.5, bins: int = 10) -> DataFrame:
    """One row: counts, accuracy, precision, recall, f1, auc, the rates and the complements of Brier score, KS and error rates, and lift.

    ks_complement: 1 - the greatest distance between the score distributions of train and test positives.  lift_statistic is
    that of lift_statistic(), lift_two_bins the same over the first two bins; rows that tie in score share a bin's edge in
    proportion.  Rows without a label or probability do not count; a figure that has no base is null.

    Scores are shuffled once: a stored table has each distinct score with its positives and negatives of test and its
    positives of train; its totals and one prefix sum over it give every figure.
    """
    def of(df: DataFrame, part: int) -> DataFrame:
        return df.select(F.col(probability).cast("double").alias("score"), (F.col(label) == 1).alias("y"), F.lit(part).alias("part")).where("score is not null and y is not null")

    both = of(test, 0).unionByName(of(train, 1))
    tested = F.col("part") == 0
    ties = both.groupBy("score").agg(F.count_if(tested & F.col("y")).alias("pos"), F.count_if(tested & ~F.col("y")).alias("neg"), F.count_if(~tested & F.col("y")).alias("base"))
    ties = stored(ties, "scores")
    pos, neg, base = (x or 0 for x in ties.agg(F.sum("pos"), F.sum("neg"), F.sum("base")).first())
    n = pos + neg
    run = cumulative(ties, ["score"], {"c_n": F.col("pos") + F.col("neg"), "c_pos": F.col("pos"), "c_neg": F.col("neg"), "c_base": F.col("base")}, descending=True)
    hit, s = F.col("score") >= threshold, F.col("score")

    def over(top, bottom):
        return F.try_divide(top, F.lit(float(bottom)))

    own = F.col("pos") + F.col("neg")
    cuts = [1 + b * (n - 1) // bins for b in range(1, bins + 1)]
    reached = [F.sum(F.col("pos") * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(F.lit(float(c)) - (F.col("c_n") - own), own), F.lit(0.0))))) for c in cuts]
    row = run.agg(
        *(F.coalesce(F.sum(F.when(h, F.col(c))), F.lit(0)).alias(k) for k, h, c in (("tp", hit, "pos"), ("fp", hit, "neg"), ("tn", ~hit, "neg"), ("fn", ~hit, "pos"))),
        F.try_divide(F.sum(F.col("pos") * (F.lit(neg) - F.col("c_neg") + F.col("neg") / 2)), F.lit(float(pos) * neg)).alias("auc"),
        (1 - over(F.sum(F.col("pos") * (1 - s) * (1 - s) + F.col("neg") * s * s), n)).alias("brier_complement"),
        (1 - F.max(F.abs(over(F.col("c_pos"), pos) - over(F.col("c_base"), base)))).alias("ks_complement"),
        F.array(*(F.round(over(100 * r, pos)) for r in reached)).alias("gain"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    gain = F.col("gain")

    def share(a, b):
        return F.try_divide(a.cast("double"), b)

    def lift(k):
        area = F.aggregate(F.slice(gain, 1, k), F.lit(0.0), lambda x, y: x + y) - gain[k - 1] / 2
        return F.try_divide(area / (100.0 * k), F.lit(1 - pos / n if n else 0.0))

    return row.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + tn + fn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
            "true_negative_rate": share(tn, tn + fp),
            "false_positive_complement": 1 - share(fp, tn + fp),
            "false_negative_complement": 1 - share(fn, tp + fn),
            "lift_statistic": lift(bins),
            "lift_two_bins": lift(min(2, bins)),
        }
    ).drop("gain")


def auc(df: DataFrame, label: str, probability: str) -> DataFrame:
    """One row: area under the ROC curve by ranks, ties counting half; null without both classes."""
    ties = df.groupBy(F.col(probability).alias("__score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    below = cumulative(stored(ties, "ties"), ["__score"], {"up_to": F.col("neg")})
    total = below.agg(F.sum(F.col("pos") * (F.col("up_to") - F.col("neg") / 2)).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return total.select(F.try_divide("wins", F.col("p") * F.col("n")).alias("auc"))


def lift_bins(df: DataFrame, label: str, probability: str, key: str, bins: int = 10) -> DataFrame:
    """A row for each bin of descending probability: size, positives, shares, cumulative gain, lift.

    Row i of n is in bin greatest(1, ceil((i - 1) * bins / (n - 1))): equal cuts of the rank, not ntile.
    """
    n = df.count()
    ranked = row_numbers(df, [probability, key], "__i", descending=True)
    at = F.greatest(F.lit(1), F.ceil((F.col("__i") - 1) * bins / F.lit(max(1, n - 1)))).cast("int")
    rows = ranked.withColumn("bin", at).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"), F.min(probability).alias("min_p"), F.max(probability).alias("max_p"))
    upto, all_ = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()  # bins rows at most
    rows = rows.withColumns({"cum_n": F.sum("n").over(upto), "cum_positives": F.sum("positives").over(upto), "__p": F.sum("positives").over(all_), "__n": F.sum("n").over(all_)})
    gain = F.try_divide(F.col("cum_positives").cast("double"), F.col("__p"))
    return rows.withColumns({"share": F.col("positives") / F.col("n"), "gain": gain, "lift": F.try_divide(gain, F.col("cum_n") / F.col("__n"))}).drop("__p", "__n")


def lift_table(df: DataFrame, label: str, probability: str, key: str, bins: int = 10) -> DataFrame:
    """lift_bins() for readers: bin, n, positives, their share, cumulative gain and lift against the base rate, in percent with one decimal."""
    rows = lift_bins(df, label, probability, key, bins)

    def percent(x):
        return F.format_string("%.1f", F.round(100 * F.col(x), 1))

    return rows.select("bin", "n", "positives", percent("share").alias("share"), percent("gain").alias("gain"), F.format_string("%.1f", F.round("lift", 1)).alias("lift"))


def spokes(figures: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys, figure, value: rows of figures, such as those of folds or candidates, in the long form that a radar plot takes."""
    return figures.select(*keys, *(F.col(n).cast("double").alias(n) for n in names)).unpivot(keys, names, "figure", "value")


def lift_statistic(df: DataFrame, label: str, probability: str, key: str, bins: int = 10) -> DataFrame:
    """One row: trapezoids under the gain curve in whole percent, over 100 * bins, divided by (1 - base rate)."""
    rows = lift_bins(df, label, probability, key, bins)
    g = F.round(F.col("gain") * 100)
    area = rows.agg((F.sum(g) - F.max_by(g, "bin") / 2).alias("area"), (F.sum("positives") / F.sum("n")).alias("rate"))
    return area.select(F.try_divide(F.col("area") / (100.0 * bins), 1 - F.col("rate")).alias("lift_statistic"))


def ks_two_sample(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """One row: the greatest distance between the distributions of a column in two tables, and their sizes."""
    both = a.select(F.col(column).cast("double").alias("x"), F.lit(1).alias("one")).unionByName(b.select(F.col(column).cast("double").alias("x"), F.lit(0).alias("one")))
    both = both.where("x is not null")
    n, m = both.agg(F.sum("one"), F.sum(1 - F.col("one"))).first()
    ties = both.groupBy("x").agg(F.sum("one").alias("n"), F.sum(1 - F.col("one")).alias("m"))
    run = cumulative(ties, ["x"], {"cn": F.col("n"), "cm": F.col("m")})
    sizes = {"n_a": F.lit(n).cast("long"), "n_b": F.lit(m).cast("long")}
    gap = F.abs(F.try_divide(F.col("cn").cast("double"), sizes["n_a"]) - F.try_divide(F.col("cm").cast("double"), sizes["n_b"]))
    return run.agg(F.max(gap).alias("ks"), *(c.alias(k) for k, c in sizes.items()))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 30) -> DataFrame:
    """bin (1..bins) and n of values within [low, high]; high itself is in the last bin."""
    x = F.col(column)
    at = F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return df.where(x.between(low, high)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
