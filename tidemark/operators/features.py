"""Window features of logs and panels; every feature of one window shares its shuffle and sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import DAY, micros, ratio, sample_skewness
from ..roles import PanelRoles, Roles


def trailing_days(df: DataFrame, roles: Roles, days: int, stats: dict[str, tuple[str, str]]) -> DataFrame:
    """Over the days up to a row (a row exactly that long ago is out): name -> (column, sum | max | min | mean | median | count).

    Rows at one moment see one another.
    """
    over = Window.partitionBy(roles.id).orderBy(micros(F.col(roles.date))).rangeBetween(1 - days * DAY, 0)
    make = {"sum": F.sum, "max": F.max, "min": F.min, "mean": F.avg, "count": F.count, "median": lambda c: F.percentile(c, F.lit(0.5))}
    return df.withColumns({k: make[how](c).over(over) for k, (c, how) in stats.items()})


def last_in_period(df: DataFrame, roles: Roles, period: str) -> DataFrame:
    """The last row of each (id, period) in event order."""
    back = Window.partitionBy(roles.id, period).orderBy(F.desc(roles.date), F.desc(roles.event))
    return df.withColumn("__n", F.row_number().over(back)).where("__n = 1").drop("__n")


def rolling_rows(panel: DataFrame, roles: PanelRoles, columns: list[str], periods: int, stats: tuple[str, ...] = ("mean", "std", "skew", "trend")) -> DataFrame:
    """Statistics of the last periods of each id, from one row on; null becomes 0.

    trend: slope of a least-squares line over the rows in order.
    """
    over = roles.rows(periods)
    panel = panel.withColumn("__at", F.row_number().over(roles.ordered()).cast("double"))
    make = {
        "mean": lambda c: F.avg(c).over(over),
        "std": lambda c: F.stddev_samp(c).over(over),
        "skew": lambda c: sample_skewness(F.col(c), over),
        "trend": lambda c: F.regr_slope(F.col(c), F.col("__at")).over(over),
        "min": lambda c: F.min(c).over(over),
        "max": lambda c: F.max(c).over(over),
        "sum": lambda c: F.sum(c).over(over),
        "median": lambda c: F.percentile(c, F.lit(0.5)).over(over),
    }
    return panel.withColumns({f"{c}_{s}_{periods}": F.coalesce(make[s](c), F.lit(0.0)) for c in columns for s in stats}).drop("__at")


def lags(panel: DataFrame, roles: PanelRoles, columns: list[str], upto: int) -> DataFrame:
    w = roles.ordered()
    return panel.withColumns({f"{c}_lag_{k}": F.coalesce(F.lag(c, k).over(w), F.lit(0)) for c in columns for k in range(1, upto + 1)})


def shift(panel: DataFrame, roles: PanelRoles, columns: list[str], by: int) -> DataFrame:
    """Values of by periods earlier (later, for a negative by); 0 where there are none."""
    w = roles.ordered()
    move = F.lag if by >= 0 else F.lead
    return panel.withColumns({f"{c}_shift_{by}": F.coalesce(move(c, abs(by)).over(w), F.lit(0)) for c in columns})


def differences(panel: DataFrame, roles: PanelRoles, columns: list[str]) -> DataFrame:
    w = roles.ordered()
    return panel.withColumns({f"{c}_diff": F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0)) for c in columns})


def rates(panel: DataFrame, roles: PanelRoles, columns: list[str]) -> DataFrame:
    """Change against the period before, relative to it; 0 where that is 0 or missing."""
    w = roles.ordered()
    return panel.withColumns({f"{c}_rate": ratio(F.col(c) - F.lag(c).over(w), F.lag(c).over(w)) for c in columns})


def cyclical(df: DataFrame, date: str) -> DataFrame:
    """sin and cos of month, quarter, ISO week and weekday, each on its full circle."""
    d = F.col(date)
    parts = {"month": (F.month(d), 12), "quarter": (F.quarter(d), 4), "week": (F.weekofyear(d), 53), "weekday": (F.weekday(d) + 1, 7)}
    return df.withColumns({f"{k}_{n}": f((v - 1) * (2 * math.pi / top)) for k, (v, top) in parts.items() for n, f in (("sin", F.sin), ("cos", F.cos))})


def ratios(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """name -> (top, bottom): price for each unit, share of failed payments; 0 where the bottom is 0."""
    return df.withColumns({k: ratio(F.col(a), F.col(b)) for k, (a, b) in pairs.items()})


def column_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_distinct and whether it has exactly two values, in one pass."""
    counts = df.agg(*(F.count_distinct(F.col(c)).alias(c) for c in columns))
    return unpivot(counts, columns, "n_distinct").withColumn("is_binary", (F.col("n_distinct") == 2).cast("int"))


def unpivot(row: DataFrame, columns: list[str], value: str) -> DataFrame:
    return row.unpivot([], [F.col(c) for c in columns], "column", value)


def enrich(panel: DataFrame, roles: PanelRoles, columns: list[str], periods: int, upto: int, date: str | None = None) -> DataFrame:
    """Rolling statistics, lags, differences and, with a date, cyclical features: one shuffle by id."""
    out = differences(lags(rolling_rows(panel, roles, columns, periods), roles, columns, upto), roles, columns)
    return cyclical(out, date) if date else out


def clip(x: Column, low: Column, high: Column) -> Column:
    """x within bounds; null stays null, and a null bound does not bind."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))
