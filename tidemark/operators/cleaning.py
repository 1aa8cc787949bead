"""Column cleaning and row filters of a raw event log."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import floor_days, log0
from ..roles import Roles


def clean_names(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Names without slashes and brackets, each once (the first stays), minus the dropped ones."""
    names, keep = [], []
    for k, c in enumerate(df.columns):
        name = re.sub(r"[()\[\]{}]", "", c.replace("/", "_"))
        keep.append(name not in names and name not in drop)
        names.append(name if keep[-1] else f"__{k}")
    return df.toDF(*names).select(*(F.col(f"`{n}`") for n, k in zip(names, keep, strict=True) if k))


def fill_forward(df: DataFrame, roles: Roles, carried: list[str], zeroed: list[str] = ()) -> DataFrame:
    """Nulls of carried columns take the id's last value, else 0; those of zeroed columns 0."""
    last = {c: F.coalesce(F.last(c, ignorenulls=True).over(roles.past()), F.lit(0)) for c in carried}
    return df.withColumns(last | {c: F.coalesce(F.col(c), F.lit(0)) for c in zeroed})


def drop_negative(df: DataFrame, tenure: str) -> DataFrame:
    return df.where(F.col(tenure) >= 0)


def drop_short_journeys(df: DataFrame, roles: Roles, tenure: str, most: float, until: Column | None = None) -> DataFrame:
    """Without ids whose greatest tenure, up to a date, is at most ``most``; ids with no row up to it go too."""
    seen = df.where(F.col(roles.date) <= until) if until is not None else df
    long_ = seen.groupBy(roles.id).agg(F.max(tenure).alias("__t")).where(F.col("__t") > most).select(roles.id)
    return df.join(long_, roles.id, "left_semi")


def keep_ids_with(df: DataFrame, roles: Roles, condition: Column) -> DataFrame:
    """Rows of ids that meet a condition at least once (a reference event, a price reached, a tenure)."""
    return df.join(df.where(condition).select(roles.id).distinct(), roles.id, "left_semi")


def event_filters(df: DataFrame, timeline: str, kind: str, dropped: tuple[str, ...], ref: str, to_next: str) -> DataFrame:
    """Rows of a begun timeline, of a wanted kind, and not on the last day before the next reference event.

    Days to the next of 0 and of 1 both go, unless the row is a reference event itself.
    """
    near = (F.col(to_next) < 0) | (F.col(ref) == 1) | (F.col(to_next) > 1)
    return df.where((F.col(timeline) > 0) & ~F.col(kind).isin(*dropped) & near)


def drop_first_day_references(df: DataFrame, roles: Roles, ref: str, days_since_start: str, timeline: str) -> DataFrame:
    """Without reference events on the first day of a journey, and without an id's first row if it opens timeline 1."""
    rest = df.where(~((F.col(ref) == 1) & (F.col(days_since_start) == 0)))
    first = F.row_number().over(roles.ordered()) == 1
    return rest.withColumn("__drop", first & (F.col(ref) == 1) & (F.col(timeline) == 1)).where("not __drop").drop("__drop")


def drop_sparse_past(df: DataFrame, date: str, today: Column, years: int, back_months: int) -> DataFrame:
    """Rows not older than the first date within the last years before today, less a number of months."""
    recent = F.col(date) >= F.add_months(today, -12 * years)
    first = df.agg(F.min(F.when(recent, F.col(date)))).first()[0]
    return df.where(F.col(date) >= F.add_months(F.lit(first), -back_months))


def truncate_after_last(df: DataFrame, roles: Roles, ref: str) -> DataFrame:
    """Rows up to and with an id's last reference event; ids without one keep all."""
    ahead = F.max(ref).over(roles.ordered().rowsBetween(0, Window.unboundedFollowing))
    return df.withColumns({"__ahead": ahead, "__any": F.max(ref).over(roles.whole())}).where("__ahead = 1 or __any = 0").drop("__ahead", "__any")


def until(df: DataFrame, date: str, end: Column) -> DataFrame:
    return df.where(F.col(date) <= end)


def since(df: DataFrame, date: str, start: Column) -> DataFrame:
    """For training rows; applied after look-back windows, which still see what is older."""
    return df.where(F.col(date) >= start)


def log_transform(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: log0(F.col(c)) for c in columns})


def drop_terminal_events(df: DataFrame, roles: Roles, ref: str) -> DataFrame:
    """Ids with a reference event lose the rows of their last date."""
    return df.withColumns({"__last": F.max(roles.date).over(roles.whole()), "__any": F.max(ref).over(roles.whole())}).where(f"not (__any = 1 and {roles.date} = __last)").drop("__last", "__any")


def side_table_sums(df: DataFrame, side: DataFrame, roles: Roles, columns: list[str]) -> DataFrame:
    """Left join of a side table summed by id and date, for ids that the log has."""
    sums = side.join(df.select(roles.id).distinct(), roles.id, "left_semi").groupBy(roles.id, roles.date).agg(*(F.sum(c).alias(c) for c in columns))
    return df.join(sums, [roles.id, roles.date], "left")


def days_between(start: str, end: str) -> Column:
    return floor_days(F.col(start), F.col(end))
