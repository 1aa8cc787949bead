"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than a _SHARE-th of the rows, so that there are at most _SHARE of them, and more than _FEW rows.
_SHARE, _FEW = 1000, 256
_SALTS = 64


def spread_join(rows: DataFrame, sized: DataFrame, keys: list[str], by: list[str], total: int | None = None) -> DataFrame:
    """rows joined to sized, which has one row for each key and ``n``, how many of the rows have it.

    A hot key's rows are dealt over several tasks by a hash of the columns
    ``by``, and its one row in sized is copied to each; the driver sees hashes of the hot keys.  sized is read
    twice and should be stored, and rows too unless their number, at least the sum of n, is given as ``total``.
    n is dropped.
    """
    total = rows.count() if total is None else total
    mark = F.xxhash64(*keys)
    hot = [r[0] for r in sized.where((F.col("n") * _SHARE > total) & (F.col("n") > _FEW)).select(mark).collect()]  # _SHARE at most
    few = sized.drop("n").hint("merge")
    if not hot:
        return rows.join(few, keys)
    dealt = rows.withColumn("__salt", F.when(mark.isin(hot), F.pmod(F.xxhash64(*by), F.lit(_SALTS))).otherwise(0).cast("int"))
    copies = F.when(mark.isin(hot), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(few.withColumn("__salt", F.explode(copies)).hint("merge"), [*keys, "__salt"]).drop("__salt")
