"""Sources with schemas (so numbers are numbers), and partitioned Parquet sinks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",", index: str | None = None) -> DataFrame:
    """Comma or tab separated text with a header; index: a row-number column to leave out."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    return df.drop(index) if index else df


def read_database(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 1, low: float | None = None, high: float | None = None, **options: str) -> DataFrame:
    """A table over JDBC, read in parts by ranges of a numeric column; names come in upper case.

    Without low and high the column's own extremes are asked for first, so that the parts cover equal ranges of what is there; rows outside
    given bounds, or with a null in the column, are read too, by the outer parts.  Filters and columns that follow are pushed to the
    database.  Credentials belong in options from the caller's secret store.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if column and parts > 1:
        if low is None or high is None:
            own = {c.upper(): c for c in spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().columns}[column.upper()]
            name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(own)
            ends = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}", **options)
            first, last = ends.load().first()
            low, high = (first if low is None else low), (last if high is None else high)
        if low is not None and high is not None and low < high:
            reader = reader.options(partitionColumn=column, lowerBound=math.floor(low), upperBound=math.ceil(high) + 1, numPartitions=parts)
    df = reader.option("dbtable", table).load()
    return df.select(*(F.col(c).alias(c.upper()) for c in df.columns))


def write_panel(df: DataFrame, path: str, period: str | None = None) -> None:
    """Parquet, in folders by period where one is given: period filters then read only their folders."""
    if period:
        df.repartition(period, F.pmod(F.xxhash64(*df.columns[:1]), F.lit(16))).write.mode("overwrite").partitionBy(period).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_reports(reports: dict[str, DataFrame], path: str) -> None:
    """Small result tables, one CSV file each in a folder of its name, and an index of them with their rows and columns."""
    for name, report in reports.items():
        write_report(report, f"{path}/{name}")
    spark = next(iter(reports.values())).sparkSession
    index = [(name, report.count(), ",".join(report.columns)) for name, report in reports.items()]
    write_report(spark.createDataFrame(index, "report string, n_rows long, columns string"), f"{path}/index")


def write_report(report: DataFrame, path: str) -> None:
    """A small result table as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
