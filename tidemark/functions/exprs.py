"""Small column expressions with the edge cases settled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000


def micros(date: Column) -> Column:
    """Microseconds since 1970 of a timestamp, in its own clock."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), date.cast("timestamp_ntz"))


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down: two hours over midnight are 0, and back again -1."""
    return F.floor((micros(end) - micros(start)) / F.lit(DAY)).cast("long")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom; 0 where either is 0 or null."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def log0(x: Column) -> Column:
    """Natural logarithm with 0 for 0."""
    return F.when(x == 0, 0.0).otherwise(F.log(x))


def to_int(x: Column) -> Column:
    """The integer a string holds, or null where it holds none."""
    return x.try_cast("bigint")


def sample_skewness(x: Column, over) -> Column:
    """Bias-corrected skewness over a window; 0 for fewer than three values or without spread."""
    n, s = F.count(x).over(over), F.skewness(x).over(over)
    fix = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return F.coalesce(F.nanvl(s * fix, F.lit(0.0)), F.lit(0.0))


def hash_share(seed: int, *keys: str) -> Column:
    """A number in [0, 1) that depends on the keys and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def digest_order(seed: int, *keys: str) -> Column:
    """A 60-bit number from the MD5 of seed and keys, for an order that any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in keys)).cast("binary")), 1, 15), 16, 10).cast("long")


def plain_ascii(x: Column) -> Column:
    """Text without characters beyond ASCII."""
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")
