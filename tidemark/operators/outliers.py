"""Robust outlier statistics and clamping, from a few aggregations over all columns at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import bracket, wide_quantiles
from .features import clip


def outlier_stats(df: DataFrame, columns: list[str], threshold: float = 10.0) -> DataFrame:
    """column, median, mad, mean_dev, low, high, n_outliers.

    The score of x is 0.6745 (x - median) / MAD, or 0.7979 (x - median) over the mean
    deviation from the mean where MAD is 0; above the threshold either way it
    is an outlier.  low and high are the extremes of the rest.  A constant column has no score and no outliers; one without a value has no row.

    Columns stay columns: five passes, each one aggregation without a shuffle of rows (mean and brackets; median;
    deviations and their brackets; MAD; bounds), whose results, a few numbers for each column, enter the next as literals.
    """
    x = {c: F.col(c).cast("double") for c in columns}
    first = df.agg(*(F.struct(F.avg(x[c]).alias("mean"), bracket(x[c], 0.5).alias("at")).alias(c) for c in columns)).first()
    held = [c for c in columns if first[c]["at"]["n"]]
    median = wide_quantiles(df, x, {c: tuple(first[c]["at"]) for c in held}, 0.5)
    off = {c: F.abs(x[c] - F.lit(median[c])) for c in held}
    second = df.agg(F.lit(1).alias("__one"), *(F.struct(F.avg(F.abs(x[c] - F.lit(first[c]["mean"]))).alias("dev"), bracket(off[c], 0.5).alias("at")).alias(c) for c in held)).first()
    mad = wide_quantiles(df, off, {c: tuple(second[c]["at"]) for c in held}, 0.5)

    def inlier(c: str) -> Column:
        dev = second[c]["dev"]
        if mad[c] > 0:
            return F.abs(0.6745 * (x[c] - F.lit(median[c])) / F.lit(mad[c])) <= threshold
        return F.abs(0.7979 * (x[c] - F.lit(median[c])) / F.lit(dev)) <= threshold if dev > 0 else F.lit(0.0 <= threshold)

    cells = [
        F.struct(
            F.lit(c).alias("column"),
            *(F.lit(float(v)).alias(k) for k, v in (("median", median[c]), ("mad", mad[c]), ("mean_dev", second[c]["dev"]))),
            F.min(F.when(inlier(c), x[c])).alias("low"),
            F.max(F.when(inlier(c), x[c])).alias("high"),
            F.count_if(x[c].isNotNull() & ~inlier(c)).alias("n_outliers"),
        ).alias(f"c{k}")
        for k, c in enumerate(held)
    ]
    if not held:
        return df.sparkSession.createDataFrame([], "column string, median double, mad double, mean_dev double, low double, high double, n_outliers long")
    return df.agg(*cells).select(F.explode(F.array(*(f"c{k}" for k in range(len(held))))).alias("r")).select("r.*")


def clamp(df: DataFrame, columns: list[str], stats: DataFrame) -> DataFrame:
    """Outliers moved to the nearest value that is none; null stays null.

    stats: outlier_stats() of these rows, or of the training rows alone to keep the others out of it.
    """
    bounds = {r["column"]: (F.lit(r["low"]), F.lit(r["high"])) for r in stats.collect()}  # a row for each column
    return df.withColumns({c: clip(F.col(c), *bounds[c]) for c in columns if c in bounds})


def candidates(columns: list[str], prefixes: tuple[str, ...], suffixes: tuple[str, ...], since: bool = False) -> list[str]:
    """The columns to look for outliers in: of a group (prefix) and made by an aggregation (suffix); since: time-since columns too."""
    return [c for c in columns if (c.startswith(prefixes) and c.endswith(suffixes)) or (since and "td_" in c)]


def zero_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, for each that adds up to 0 in absolute values or has no value: nothing to learn from or clamp.

    One aggregation of a row with a cell for each column.
    """
    sums = df.agg(*(F.coalesce(F.max(F.abs(F.col(c).cast("double"))), F.lit(0.0)).alias(c) for c in columns))
    return sums.unpivot([], columns, "column", "most").where("most = 0").select("column")
