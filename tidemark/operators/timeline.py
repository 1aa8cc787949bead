"""Reference events, timelines and time-since features; one shuffle by id, windows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import floor_days
from ..roles import Roles


def mark_reference(df: DataFrame, roles: Roles, condition: Column, ref: str = "ref_event", timeline: str = "timeline") -> DataFrame:
    """ref: 1 on reference events, else 0.  timeline: how many the id has had so far, this row included."""
    flag = F.coalesce(condition.cast("int"), F.lit(0))
    return df.withColumn(ref, flag).withColumn(timeline, F.sum(ref).over(roles.past()))


def mark_indicator(df: DataFrame, roles: Roles, indicator: str, ref: str = "ref_event", timeline: str = "timeline") -> DataFrame:
    """mark_reference() where a column tells the reference events (1, true or a number above 0); the column goes."""
    return mark_reference(df, roles, F.coalesce(F.col(indicator).cast("double"), F.lit(0.0)) > 0, ref, timeline).drop(indicator)


def as_running(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that hold running totals already, under the names that running_sums() gives."""
    return df.withColumnsRenamed({c: f"expanding_{c}" for c in columns})


def time_since_reference(df: DataFrame, roles: Roles, ref: str = "ref_event") -> DataFrame:
    """Days since the journey began, since the timeline began, and to the next timeline (-999 if none).

    A journey begins on the id's first date; a timeline on its reference event, or
    with the journey before any.  A later reference event is a next timeline only
    if it is more than zero whole days after the reference event before it.
    """
    date, is_ref = F.col(roles.date), F.col(ref) == 1
    start = F.min(date).over(roles.whole())
    current = F.coalesce(F.last(F.when(is_ref, date), ignorenulls=True).over(roles.past()), start)
    previous = F.last(F.when(is_ref, date), ignorenulls=True).over(roles.ordered().rowsBetween(-(1 << 31), -1))
    opens = is_ref & (previous.isNull() | (floor_days(previous, date) > 0))
    df = df.withColumns({"__start": start, "__current": current, "__opens": F.when(opens, date)})
    ahead = F.first("__opens", ignorenulls=True).over(roles.future())
    return df.withColumns(
        {
            "days_since_start": floor_days(F.col("__start"), date),
            "days_since_timeline": floor_days(F.col("__current"), date),
            "days_to_next": F.coalesce(floor_days(date, ahead), F.lit(-999)).cast("long"),
        }
    ).drop("__start", "__current", "__opens")


def days_since_last(df: DataFrame, roles: Roles, conditions: dict[str, Column]) -> DataFrame:
    """For each name, days since the id last met its condition (0 on such a row); -1 before the first."""
    date = F.col(roles.date)
    return df.withColumns({k: F.coalesce(floor_days(F.last(F.when(c, date), ignorenulls=True).over(roles.past()), date), F.lit(-1)).cast("long") for k, c in conditions.items()})


def running_sums(df: DataFrame, roles: Roles, columns: list[str], prefix: str = "expanding_") -> DataFrame:
    return df.withColumns({prefix + c: F.sum(c).over(roles.past()) for c in columns})


def row_sums(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """A column for each group: the sum of its columns in the row, null as 0."""
    return df.withColumns({k: sum((F.coalesce(F.col(c), F.lit(0)) for c in cs), F.lit(0)) for k, cs in groups.items()})
