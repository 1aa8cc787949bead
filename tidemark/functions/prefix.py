"""Cumulative sums, row numbers and quantiles over a whole table, without one task that sees it all.

A window without partitions sends every row to one task.  Here the leading
order column is cut at approximate quantiles; a bucket's base is the sum of the
buckets before it (a small table), and windows run inside the buckets.  A value
that fills a bucket alone is cut further by the next order column.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..sources.stored import stored


#: percentile_approx() is off by at most a share of 1 / _ACCURACY of a group's rows.
_ACCURACY = 10000


def _cuts(df: DataFrame, column: str, buckets: int) -> list[float]:
    return df.approxQuantile(column, [i / buckets for i in range(1, buckets)], 0.5 / buckets)


def bucket_of(df: DataFrame, order: list[str], buckets: int, descending: bool = False) -> Column:
    """Bucket number of a row, rising in the wanted order; fewer than 2 * buckets**2 of them.

    Values of order[0] that two cuts name hold a bucket's worth of rows each; their rows are cut
    by order[1], if that is a number, so that ties meet in no single task.
    """
    lead, cuts = F.col(order[0]), _cuts(df, order[0], buckets)
    hot = sorted({c for c in cuts if cuts.count(c) > 1})
    if not cuts:
        return F.lit(0)

    def below(at: list[float], x: Column) -> Column:
        # No lambda: Spark does not see a column that a lambda takes from outside, and filters the other side of a join by it.
        return reduce(lambda n, c: n + F.when(x > F.lit(float(c)), 1).otherwise(0), sorted(set(at)), F.lit(0))

    number = below(cuts, lead) * (2 * buckets)
    if hot and len(order) > 1 and isinstance(df.schema[order[1]].dataType, NumericType):
        tied = lead.cast("double").isin(hot)
        fine = _cuts(df.where(tied), order[1], buckets)
        if fine:
            number = number + F.when(tied, buckets + below(fine, F.col(order[1]))).otherwise(0)
    return -number if descending else number


def cumulative(df: DataFrame, order: list[str], sums: dict[str, Column], descending: bool = False, buckets: int = 64) -> DataFrame:
    """Add, for each name, the sum of its column over all rows up to and including this one.

    order[0] must be numeric; order must be total for the result to be unique.
    """
    rows = df.withColumn("__bucket", bucket_of(df, order, buckets, descending)).withColumns({f"__v_{k}": v for k, v in sums.items()})
    direction = [F.desc(c) if descending else F.asc(c) for c in order]
    totals = rows.groupBy("__bucket").agg(*(F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__bucket", *(F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__b_{k}") for k in sums))
    inside = Window.partitionBy("__bucket").orderBy(*direction).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(F.broadcast(bases), "__bucket")
    out = out.withColumns({k: F.col(f"__b_{k}") + F.sum(f"__v_{k}").over(inside) for k in sums})
    return out.drop("__bucket", *(f"__{p}_{k}" for k in sums for p in "vb"))


def row_numbers(df: DataFrame, order: list[str], name: str = "row_number", descending: bool = False, buckets: int = 64) -> DataFrame:
    """Add 1, 2, 3, ... over the whole table in the given total order."""
    return cumulative(df, order, {name: F.lit(1).cast("long")}, descending, buckets)


def grouped_quantile(rows: DataFrame, keys: list[str], value: str, q: float, name: str, buckets: int = 64) -> DataFrame:
    """keys and the exact q-quantile of value in each group, interpolated between neighbours; nulls do not count.

    Spark's percentile() keeps every distinct value of a group in one task's
    memory.  Here a first aggregation brackets the wanted rank between two approximate
    percentiles, five times their error bound apart on each side (groups of up to _ACCURACY rows are
    taken whole); a second counts the values below the bracket and, value by value, those inside.  Only the latter, about a
    thousandth of the rows, are shuffled; they are ranked in ``buckets`` equal steps of the bracket.  A rank outside
    its bracket would raise an error.  Groups are few (columns, periods): a row for each is broadcast.
    """
    x, slack = F.col(value), 5 / _ACCURACY
    known = rows.where(x.isNotNull()).select(*keys, value)
    ends = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__all"), F.min(value).alias("__min"), F.max(value).alias("__max"),
        F.percentile_approx(value, [max(0.0, q - slack), min(1.0, q + slack)], _ACCURACY).alias("__ends"),
    )
    whole = F.col("__all") <= _ACCURACY
    ends = ends.select(*keys, "__all", F.when(whole, F.col("__min")).otherwise(F.col("__ends")[0]).alias("__low"), F.when(whole, F.col("__max")).otherwise(F.col("__ends")[1]).alias("__high"))
    near = known.join(F.broadcast(ends), keys).where(x <= F.col("__high"))
    near = near.withColumn(value, F.when(x >= F.col("__low"), x))  # null: below the bracket
    ties = near.groupBy(*keys, "__all", "__low", "__high", value).agg(F.count(F.lit(1)).alias("__n"))
    step = F.try_divide((x - F.col("__low")).cast("double"), (F.col("__high") - F.col("__low")).cast("double")) * buckets
    ties = ties.withColumn("__bucket", F.when(x.isNull(), -1).otherwise(F.coalesce(F.floor(step).cast("int"), F.lit(0))))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = ties.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__t"))
    totals = totals.select(*keys, "__bucket", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    run = ties.withColumn("__c", F.sum("__n").over(inside)).join(F.broadcast(totals), [*keys, "__bucket"]).withColumn("__c", F.col("__c") + F.col("__base"))
    at = F.lit(q) * (F.col("__all") - 1)
    # A null is the least, so a rank that lies below the bracket is seen by the row of nulls having enough.
    lost = F.max(F.when(x.isNull() & (F.col("__c") >= F.floor(at) + 1), True).otherwise(False)) | (F.max("__c") < F.first(F.ceil(at) + 1))
    low = F.min(F.when(F.col("__c") >= F.floor(at) + 1, x))
    high = F.min(F.when(F.col("__c") >= F.ceil(at) + 1, x))
    part = F.first(at - F.floor(at))
    found = run.groupBy(*keys).agg(lost.alias("__lost"), (low + (high - low) * part).alias(name))
    return found.select(*keys, F.when(F.col("__lost"), F.raise_error("a rank lies outside its bracket").cast("double")).otherwise(F.col(name)).alias(name))


def bracket(x: Column, q: float) -> Column:
    """An aggregate that tells where the exact q-quantile of x lies: n, low, high.

    low and high are approximate percentiles, five times their error bound apart on each side; groups of up to _ACCURACY values are
    taken whole.
    """
    slack = 5 / _ACCURACY
    ends = F.percentile_approx(x, [max(0.0, q - slack), min(1.0, q + slack)], _ACCURACY)
    whole = F.count(x) <= _ACCURACY
    return F.struct(F.count(x).alias("n"), F.when(whole, F.min(x)).otherwise(ends[0]).alias("low"), F.when(whole, F.max(x)).otherwise(ends[1]).alias("high"))


def wide_quantiles(df: DataFrame, values: dict[str, Column], ends: dict[str, tuple[int, float, float]], q: float, buckets: int = 64) -> dict[str, float]:
    """The exact q-quantile of each of a row's values, interpolated between neighbours; ends: bracket() of each, without those of no value.

    One pass over df: it counts what lies below each bracket while values inside, about a thousandth, leave
    the row and are counted by value.  Only these counts are shuffled and ranked, in ``buckets`` equal steps.
    """
    names = list(ends)
    if not names:
        return {}
    below = Observation()
    cells = F.array(*(F.struct(F.lit(k).alias("k"), F.when(values[c].between(F.lit(ends[c][1]), F.lit(ends[c][2])), values[c]).alias("x")) for k, c in enumerate(names)))
    watched = df.observe(below, *(F.count_if(values[c] < F.lit(ends[c][1])).alias(f"b{k}") for k, c in enumerate(names)))
    inside = watched.select(F.explode(F.filter(cells, lambda r: r["x"].isNotNull())).alias("r")).select("r.*")
    ties = stored(inside.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n")), "inside")
    counts = below.get
    low, span = (F.array(*(F.lit(float(v)) for v in vs))[F.col("k")] for vs in ([ends[c][1] for c in names], [ends[c][2] - ends[c][1] for c in names]))
    placed = ties.withColumn("bucket", F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - low, span) * buckets), F.lit(buckets)).cast("int"), F.lit(0)))
    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("k", "bucket").agg(F.sum("n").alias("t")).select("k", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    upto = Window.partitionBy("k", "bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumn("c", F.sum("n").over(upto)).join(F.broadcast(bases), ["k", "bucket"]).withColumn("c", F.col("c") + F.col("base"))
    at = [q * (ends[c][0] - 1) - counts[f"b{k}"] for k, c in enumerate(names)]
    first, second = (F.array(*(F.lit(f(a) + 1) for a in at))[F.col("k")] for f in (math.floor, math.ceil))
    found = {r["k"]: r for r in run.groupBy("k").agg(F.min(F.when(F.col("c") >= first, F.col("x"))).alias("a"), F.min(F.when(F.col("c") >= second, F.col("x"))).alias("b"), F.max("c").alias("n")).collect()}
    out = {}
    for k, c in enumerate(names):
        r = found.get(k)
        if r is None or at[k] < 0 or r["n"] < math.ceil(at[k]) + 1:
            raise ValueError(f"a rank of {c} lies outside its bracket")
        out[c] = r["a"] + (r["b"] - r["a"]) * (at[k] - math.floor(at[k]))
    return out
