"""Calendar periods: 0 is the newest, numbers grow into the past, -1 lies outside.

Units are counted in closed form (months since year 0, weeks since a Monday), so
a week that spans new year and the 53rd week of a year need no special table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def unit_number(date: Column, unit: str) -> Column:
    """A running number of the calendar unit that holds a date."""
    if unit == "month":
        return F.year(date) * 12 + F.month(date)
    if unit == "quarter":
        return F.year(date) * 4 + F.quarter(date)
    if unit == "year":
        return F.year(date)
    days = F.datediff(date.cast("date"), F.lit("1970-01-05").cast("date"))  # a Monday
    return F.floor(days / 7).cast("int") if unit == "week" else days


def year_unit(date: Column, unit: str) -> Column:
    """The calendar name of a unit as an integer, year * 100 + unit (year * 1000 + day for days)."""
    if unit == "week":
        return F.extract(F.lit("YEAROFWEEK"), date) * 100 + F.weekofyear(date)
    if unit == "day":
        return F.year(date) * 1000 + F.dayofyear(date)
    part = {"month": F.month, "quarter": F.quarter}[unit]
    return F.year(date) * 100 + part(date)


def assign_period(df: DataFrame, date: str, unit: str, length: int = 1, end: Column | None = None, name: str = "period") -> DataFrame:
    """Add the period of each row: units back from the end date's unit, in groups of length.

    end: the last date that counts; by default the latest in df, found by a pass over that column alone.
    """
    own = unit_number(F.col(date), unit)
    if end is None:
        end = F.lit(df.agg(F.max(date)).first()[0])
    back = unit_number(end, unit) - own
    return df.withColumn(name, F.when(back < 0, -1).otherwise(F.floor(back / length)).cast("int"))


def calendar_of(df: DataFrame, date: str, unit: str) -> DataFrame:
    """unit, period, n: every unit from a table's first date to its last, with how many rows fall in it, none included.

    One aggregation by unit; the calendar has a row for each unit and joins it by broadcast.
    """
    counts = df.where(F.col(date).isNotNull()).groupBy(unit_number(F.col(date), unit).alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.min("unit").alias("a"), F.max("unit").alias("b")).where("a is not null")
    spine = ends.select("b", F.explode(F.sequence("a", "b")).alias("unit"))
    return spine.join(F.broadcast(counts), "unit", "left").select("unit", (F.col("b") - F.col("unit")).alias("period"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def calendar(spark: SparkSession, start: str, end: str, unit: str) -> DataFrame:
    """The unit numbers between two dates, newest first in their period numbers."""
    ends = spark.sql("select 1").select(unit_number(F.lit(start).cast("date"), unit).alias("a"), unit_number(F.lit(end).cast("date"), unit).alias("b"))
    return ends.select(F.col("b"), F.explode(F.sequence("a", "b")).alias("unit")).select("unit", (F.col("b") - F.col("unit")).alias("period"))
