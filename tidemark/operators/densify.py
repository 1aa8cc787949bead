"""One row for each id and period: collapse, densify, fill and label."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import floor_days
from ..roles import Duration, PanelRoles, Roles


def collapse(df: DataFrame, roles: Roles, period: str, columns: list[str], sums: list[str] = ()) -> DataFrame:
    """The last value that is not null of each column within an (id, period), in event order; sums are added up."""
    order = F.struct(roles.date, roles.event)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    return df.groupBy(roles.id, period).agg(*last, *(F.sum(c).alias(c) for c in sums))


def densify(panel: DataFrame, roles: PanelRoles, imputed: str = "imputed", periods: list[int] | None = None) -> DataFrame:
    """Add the periods in which an id has no row, from its first period on, marked 1 (others 0).

    periods: those to be filled, by default the ones that any id has (found by a
    pass of its own; as many as the calendar has).  Each row brings forth the gaps up to the id's
    next row: one window by id, no join, no ids x periods product, and nothing before an id's first period.
    """
    if periods is None:
        periods = sorted(r[0] for r in panel.where(F.col(roles.period) >= 0).select(roles.period).distinct().collect())
    low = periods[0] if periods else 0
    newer = F.lead(roles.period).over(roles.ordered())
    run = F.when(F.col(roles.period) < 0, F.array(roles.period)).otherwise(F.sequence(roles.period, F.greatest(F.coalesce(newer + 1, F.lit(low)), F.lit(0))))
    rest = [c for c in panel.columns if c not in (roles.id, roles.period)]
    out = panel.withColumn("__run", run).select(roles.id, *rest, F.posexplode("__run").alias("__at", roles.period))
    if periods and periods != list(range(periods[0], periods[-1] + 1)):
        out = out.where((F.col("__at") == 0) | F.col(roles.period).isin(periods))
    else:
        out = out.where((F.col("__at") == 0) | (F.col(roles.period) >= low))
    own = {c: F.when(F.col("__at") == 0, F.col(c)) for c in rest}
    return out.select(*(own.get(c, F.col(c)).alias(c) for c in panel.columns), F.when(F.col("__at") == 0, 0).otherwise(1).alias(imputed))


def fill_gaps(panel: DataFrame, roles: PanelRoles, imputed: str, zeros: list[str] = (), carried: list[str] = (), since: list[str] = (), dates: list[str] = (), period_days: int = 30) -> DataFrame:
    """Values of imputed periods: zeros, the last value, time-since and dates moved on by the periods that passed.

    A time-since of exactly 0 is not moved on; a negative one (never yet) becomes -1.
    """
    w = roles.ordered().rowsBetween(Window.unboundedPreceding, 0)
    gap = F.col(imputed) == 1
    run = F.sum(1 - F.col(imputed)).over(w)
    panel = panel.withColumn("__run", run)
    k = F.row_number().over(Window.partitionBy(roles.id, "__run").orderBy(F.desc(roles.period))) - 1
    panel = panel.withColumn("__k", k)

    def last(c):
        return F.last(c, ignorenulls=True).over(w)

    moved = {c: F.when(gap, F.when(last(c) > 0, last(c) + F.col("__k") * period_days).when(last(c) < 0, F.lit(-1)).otherwise(last(c))).otherwise(F.col(c)) for c in since}
    return panel.withColumns(
        {c: F.when(gap, F.lit(0)).otherwise(F.col(c)) for c in zeros}
        | {c: F.when(gap, last(c)).otherwise(F.col(c)) for c in carried}
        | moved
        | {c: F.when(gap, last(c) + F.make_dt_interval(F.col("__k") * period_days)).otherwise(F.col(c)) for c in dates}
    ).drop("__run", "__k")


@dataclass(frozen=True)
class Filling:
    """How empty periods are filled; the same one serves training and scoring."""

    zeros: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    since: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    period_days: int = 30

    def for_horizon(self, horizon: str) -> "Filling":
        """The same with empty periods as long as a horizon such as "2month"."""
        return replace(self, period_days=Duration.parse(horizon).days)

    def fill(self, panel: DataFrame, roles: PanelRoles, imputed: str = "imputed") -> DataFrame:
        return fill_gaps(panel, roles, imputed, self.zeros, self.carried, self.since, self.dates, self.period_days)


def training_panel(panel: DataFrame, roles: PanelRoles, filling: Filling, imputed: str = "imputed") -> DataFrame:
    """Every period of an id from its first to its last real one, gaps filled."""
    return drop_trailing_imputed(filling.fill(densify(panel, roles, imputed), roles, imputed), roles, imputed)


def scoring_panel(panel: DataFrame, roles: PanelRoles, filling: Filling, at: int = 0, imputed: str = "imputed") -> DataFrame:
    """An id's newest row and, filled as in training, the empty periods from there up to period ``at``.

    What carries over is the last known value of each column, so one aggregation by id gives the anchor and each
    anchor brings forth its own rows: no window, no join, no ids x periods product.  Rows newer than ``at`` do
    not count; an id without any other is left out.
    """
    period = F.col(roles.period)
    newest = -period
    order = {c: F.when(F.col(c).isNotNull(), newest) if c in filling.carried + filling.since + filling.dates else newest for c in panel.columns if c not in (roles.id, roles.period)}
    anchors = panel.where(period >= at).groupBy(roles.id).agg(F.min(roles.period).alias("__anchor"), *(F.max_by(c, by).alias(c) for c, by in order.items()))
    steps = anchors.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__anchor") - at)))
    k, gap = F.col("__k"), F.col("__k") > 0
    moved = {c: F.when(gap & (F.col(c) > 0), F.col(c) + k * filling.period_days).when(gap & (F.col(c) < 0), F.lit(-1)).otherwise(F.col(c)) for c in filling.since}
    zeros = {c: F.when(gap, F.lit(0)).otherwise(F.col(c)) for c in filling.zeros}
    dates = {c: F.when(gap, F.col(c) + F.make_dt_interval(k * filling.period_days)).otherwise(F.col(c)) for c in filling.dates}
    rest = {c: F.when(~gap, F.col(c)) for c in order if c not in filling.zeros + filling.carried + filling.since + filling.dates}
    made = zeros | moved | dates | rest
    kinds = dict(panel.dtypes)
    columns = [(F.col("__anchor") - k).cast(kinds[c]).alias(c) if c == roles.period else made.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in panel.columns]
    return steps.select(*columns, gap.cast("int").alias(imputed))


def apply_offset(df: DataFrame, period: str, offset: int) -> DataFrame:
    """Without the periods newer than offset, whose labels are incomplete; offset becomes period 0."""
    return df.where(F.col(period) >= offset).withColumn(period, F.col(period) - F.lit(offset))


def label_next(df: DataFrame, roles: Roles, ref: Column, horizon_days: int, name: str = "target", start: Column | None = None) -> DataFrame:
    """1 if a reference event on a later row of the id is fewer than horizon days away, else 0.

    start: where the distance is measured from (the row's date; the end of its
    period, say).  The row itself never counts.
    """
    date = F.col(roles.date)
    ahead = F.first(F.when(ref, date), ignorenulls=True).over(roles.future())
    return df.withColumn(name, F.coalesce((floor_days(date if start is None else start, ahead) < horizon_days).cast("int"), F.lit(0)))


def drop_trailing_imputed(panel: DataFrame, roles: PanelRoles, imputed: str = "imputed") -> DataFrame:
    """Without imputed periods after an id's last real one."""
    ahead = F.max(1 - F.col(imputed)).over(roles.ordered().rowsBetween(0, Window.unboundedFollowing))
    return panel.withColumn("__real", ahead).where("__real = 1").drop("__real")


def drop_terminal_period(panel: DataFrame, roles: PanelRoles, ref: Column) -> DataFrame:
    """Periods before the newest one with a reference event; ids without any keep all."""
    newest = F.min(F.when(ref, F.col(roles.period))).over(Window.partitionBy(roles.id))
    return panel.withColumn("__ref", F.coalesce(newest, F.lit(-999))).where(F.col(roles.period) > F.col("__ref")).drop("__ref")


def label_offset(df: DataFrame, date: str, period: str, last: Column, horizon_days: int) -> DataFrame:
    """One row: the smallest period in which every row's label horizon is complete."""
    rows = df.where(F.col(period) >= 0).groupBy(period).agg(F.max(date).alias("__d"))
    return rows.where(floor_days(F.col("__d"), last) >= horizon_days).agg(F.min(period).alias("label_offset"))
