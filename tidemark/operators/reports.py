"""Data-quality reports, each one aggregation over all columns instead of a job for every statistic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import grouped_quantile
from .metrics import ks_two_sample


def long_form(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """column, x: the columns' values as doubles, a row each."""
    return df.select(*keep, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns))).alias("r")).select(*keep, "r.column", "r.x")


def _stats() -> list[Column]:
    return [F.count("x").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("stddev")]


def _with_median(long: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics of x in each group of a long table; the medians are exact, and no task holds a group's values."""
    return long.groupBy(*keys).agg(*_stats()).join(grouped_quantile(long, keys, "x", 0.5, "median"), keys, "left")


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """column with n, min, max, mean, stddev and median; values are numbers here, whatever the file said."""
    return _with_median(long_form(df, columns), ["column"])


def stats_delta(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """column with after minus before of min, max, mean, stddev and median."""
    a, b = column_stats(before, columns), column_stats(after, columns)
    return a.alias("a").join(b.alias("b"), "column").select("column", *((F.col(f"b.{c}") - F.col(f"a.{c}")).alias(f"delta_{c}") for c in ("min", "max", "mean", "stddev", "median")))


def event_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """column and the share of its rows that are not zero; null is no event."""
    return long_form(df, columns).groupBy("column").agg((F.count_if(F.col("x") != 0) / F.count(F.lit(1))).alias("event_rate"))


def treatments(df: DataFrame, columns: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """column_stats() with the treatment of each column; a column in two groups comes twice, one in none has null."""
    names = [(c, g) for g, cs in groups.items() for c in cs]
    return column_stats(df, columns).join(F.broadcast(df.sparkSession.createDataFrame(names, "column string, treatment string")), "column", "left")


def per_period_stats(panel: DataFrame, period: str, columns: list[str]) -> DataFrame:
    """period and column with their statistics."""
    return _with_median(long_form(panel, columns, [period]), [period, "column"])


def per_period_tall(panel: DataFrame, period: str, column: str) -> DataFrame:
    """period, statistic and value of a column, for every period."""
    stats = per_period_stats(panel, period, [column]).drop("column")
    return stats.unpivot([period], [c for c in stats.columns if c != period and c != "n"], "statistic", "value")


def per_period_wide(panel: DataFrame, period: str, column: str, newest: int | None = None) -> DataFrame:
    """A row for each statistic of a column, with a column for each of the newest periods; all periods of the data without a number."""
    if newest is None:
        newest = int(panel.agg(F.max(period)).first()[0] or 0) + 1
    tall = per_period_tall(panel.where(F.col(period) < newest), period, column)
    return tall.groupBy("statistic").pivot(period, list(range(newest))).agg(F.first("value"))


def target_by_period(panel: DataFrame, period: str, target: str) -> DataFrame:
    """period with rows, positives and rows for each positive."""
    t = panel.groupBy(period).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("positives"))
    return t.withColumn("rows_per_positive", F.try_divide(F.col("n").cast("double"), F.col("positives")))


def missing_share(panel: DataFrame, id: str, period: str, imputed: str) -> DataFrame:
    """An id's imputed share of its distinct periods; ids without an imputed one are left out."""
    per = panel.groupBy(id).agg(F.count_distinct(period).alias("periods"), F.count_distinct(F.when(F.col(imputed) == 1, F.col(period))).alias("missing"))
    return per.where("missing > 0").select(id, (F.col("missing") / F.col("periods")).alias("missing_share"))


def missing_buckets(panel: DataFrame, id: str, period: str, imputed: str, edges: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """edge and the share of all ids whose missing share is at least the edge (and above 0)."""
    shares = panel.select(id).distinct().join(missing_share(panel, id, period, imputed), id, "left")
    row = shares.agg(*(F.avg(F.when(F.col("missing_share") >= e, 1.0).otherwise(0.0)).alias(str(e)) for e in edges))
    return row.unpivot([], [F.col(f"`{e}`") for e in edges], "edge", "share_of_ids").withColumn("edge", F.col("edge").cast("double"))


def positives_per_id(panel: DataFrame, id: str, target: str) -> DataFrame:
    """One row: statistics of how many positives ids have, over ids with at least one."""
    per = panel.where(F.col(target) == 1).groupBy(id).agg(F.count(F.lit(1)).cast("double").alias("x")).withColumn("of", F.lit("positives"))
    return _with_median(per, ["of"]).drop("of")


def positive_share_by_period(panel: DataFrame, id: str, period: str, target: str) -> DataFrame:
    """period and the share of its ids that are positive in it, to two places."""
    share = F.count_distinct(F.when(F.col(target) == 1, F.col(id))) / F.count_distinct(id)
    return panel.groupBy(period).agg(F.round(share, 2).alias("positive_share"))


def funnel(steps: dict[str, DataFrame], id: str, target: str | None = None) -> DataFrame:
    """step with its rows, ids and ids with a positive."""
    out = None
    for name, df in steps.items():
        hit = F.count_distinct(F.when(F.col(target) == 1, F.col(id))) if target and target in df.columns else F.lit(None).cast("long")
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(id).alias("n_ids"), hit.alias("n_positive_ids")).select(F.lit(name).alias("step"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def leakage(train: DataFrame, test: DataFrame, id: str) -> DataFrame:
    """One row: distinct ids of train, of test, and of both."""
    both = train.select(id, F.lit(1).alias("a")).unionByName(test.select(id, F.lit(2).alias("a"))).groupBy(id).agg(F.max(F.when(F.col("a") == 1, 1).otherwise(0)).alias("t"), F.max(F.when(F.col("a") == 2, 1).otherwise(0)).alias("v"))
    return both.agg(F.sum("t").cast("long").alias("train_ids"), F.sum("v").cast("long").alias("test_ids"), F.count_if((F.col("t") == 1) & (F.col("v") == 1)).alias("both_ids"))


def drift(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """column with the change of its statistics and the KS distance between train and test."""
    out = None
    for c in columns:
        row = ks_two_sample(train, test, c).select(F.lit(c).alias("column"), "ks")
        out = row if out is None else out.unionByName(row)
    return stats_delta(train, test, columns).join(F.broadcast(out), "column")


def lineage(columns: DataFrame, name: str, suffixes: dict[str, str]) -> DataFrame:
    """The transformation that a column name's suffix tells (the longest that fits; raw if none), and the name without it."""
    ordered = sorted(suffixes, key=len, reverse=True)
    pattern = "^(.*?)(" + "|".join(ordered) + ")$"
    suffix = F.regexp_extract(name, pattern, 2)
    what = F.lit("raw")
    for s in reversed(ordered):
        what = F.when(suffix.rlike(f"^{s}$"), suffixes[s]).otherwise(what)
    return columns.withColumns({"source": F.when(suffix == "", F.col(name)).otherwise(F.regexp_extract(name, pattern, 1)), "transform": what})


def imputed_union(train: DataFrame, predict: DataFrame) -> DataFrame:
    """Both tables' rows, columns matched by name and null where a table lacks one, with part telling which."""
    return train.withColumn("part", F.lit("train")).unionByName(predict.withColumn("part", F.lit("predict")), allowMissingColumns=True)


def period_lengths(df: DataFrame, period: str, date: str) -> DataFrame:
    """period with its first and last date and how many days they span, both included."""
    ends = df.groupBy(period).agg(F.to_date(F.min(date)).alias("first_date"), F.to_date(F.max(date)).alias("last_date"))
    return ends.withColumn("days", F.date_diff("last_date", "first_date") + 1)


def suffixed(df: DataFrame, suffix: str, keys: list[str]) -> DataFrame:
    """df with a suffix on every column but the keys, so that tables of one shape can be joined side by side."""
    return df.toDF(*(c if c in keys else f"{c}{suffix}" for c in df.columns))
