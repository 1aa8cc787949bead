"""Leak-safe splits, folds and class rebalancing; random choices are hashes of keys, so they are the same everywhere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import digest_order, hash_share
from ..functions.prefix import row_numbers


def period_split(panel: DataFrame, period: str, newest: int) -> tuple[DataFrame, DataFrame]:
    """(train, validate): validate has the periods up to newest, train the older ones."""
    return panel.where(F.col(period) > newest), panel.where(F.col(period) <= newest)


def id_split(df: DataFrame, id: str, share: float, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(train, rest): whole ids, about that share of them in train."""
    inside = hash_share(seed, id) < share
    return df.where(inside), df.where(~inside)


def id_share(df: DataFrame, id: str, share: float, seed: int = 7) -> DataFrame:
    """All rows of about that share of the ids, by their digests: the same ids in any engine, for a lighter cross-validation."""
    return df.where(digest_order(seed, id) < int(share * (1 << 60)))


def split_parts(panel: DataFrame, id: str, period: str, how: str, newest: int = 0, share: float = 0.7, ref: Column | None = None, key: str | None = None, seed: int = 7) -> dict[str, DataFrame]:
    """train and validate (and predict, where there are reference events) by one of the ways to split.

    period: validate has the periods up to newest.  ids: whole ids, newest periods of the held ones alone.  in_time: whole ids, one row of
    each held one.  With ref, predict has the rows of period newest of the ids without a reference event in it.
    """
    if how == "period":
        train, validate = period_split(panel, period, newest)
    elif how == "ids":
        train, held = id_split(panel, id, share, seed)
        train, validate = train.where(F.col(period) > newest), held.where(F.col(period) <= newest)
    elif how == "in_time":
        train, validate = in_time_split(panel, id, key or period, share, seed)
    else:
        raise ValueError(f"no way to split: {how!r}")
    parts = {"train": train, "validate": validate}
    if ref is not None:
        parts["predict"] = predict_split(panel, id, period, newest, ref)
    return parts


def predict_split(panel: DataFrame, id: str, period: str, at: int, ref: Column) -> DataFrame:
    """Rows of one period, without ids that have a reference event in it."""
    rows = panel.where(F.col(period) == at)
    return rows.join(rows.where(ref).select(id).distinct(), id, "left_anti")


def in_time_split(panel: DataFrame, id: str, key: str, share: float, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(train, held): whole ids; of each held id one row, chosen by a hash of (id, key)."""
    train, held = id_split(panel, id, share, seed)
    pick = Window.partitionBy(id).orderBy(F.xxhash64(F.lit(seed), id, key), key)
    return train, held.withColumn("__n", F.row_number().over(pick)).where("__n = 1").drop("__n")


def fold_assign(df: DataFrame, order: list[str], folds: int) -> DataFrame:
    """Add fold: contiguous slices of floor(n / folds) rows in the given total order; the remainder has null."""
    size = df.count() // folds
    at = F.floor((F.col("__row") - 1) / max(1, size))
    return row_numbers(df, order, "__row").withColumn("fold", F.when((at < folds) & F.lit(size > 0), at).cast("int")).drop("__row")


def fold_parts(df: DataFrame, keys: list[str], fold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) for the keys of one fold: those outside it and those in it."""
    own = fold.select(*keys).distinct()
    return df.join(own, keys, "left_anti"), df.join(own, keys, "left_semi")


def validation_parts(train: DataFrame, validate: DataFrame, period: str, oldest: int, newest: int) -> tuple[DataFrame, DataFrame]:
    """(train, test): train periods up to oldest with the validate periods above newest; test the validate rest."""
    return train.where(F.col(period) <= oldest).unionByName(validate.where(F.col(period) > newest)), validate.where(F.col(period) <= newest)


def _class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)).first()
    return row[0], row[1]


def keep_by_hash(rows: DataFrame, keys: list[str], n: int, seed: int = 7, order: Column | None = None) -> DataFrame:
    """n rows, those with the smallest hash of their keys; order: a number of 60 bits instead of that hash.

    The cut is found on a narrow histogram of hash prefixes; only the prefix that
    holds the cut is ranked, so no task sees all rows.
    """
    if n <= 0:
        return rows.limit(0)
    if order is None:
        slot, finer = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 48), F.xxhash64(F.lit(seed + 1), *keys)
    else:
        slot, finer = F.shiftrightunsigned(order, 44), order
    rows = rows.withColumns({"__slot": slot, "__hash": finer})
    total, edge = 0, None
    for r in rows.groupBy("__slot").count().orderBy("__slot").collect():  # 65,536 rows at most
        if total + r["count"] >= n:
            edge = r["__slot"]
            break
        total += r["count"]
    if edge is None:
        return rows.drop("__slot", "__hash")
    inside = rows.where(F.col("__slot") < edge)
    at = rows.where(F.col("__slot") == edge).withColumn("__n", F.row_number().over(Window.partitionBy("__slot").orderBy("__hash", *keys))).where(F.col("__n") <= n - total).drop("__n")
    return inside.unionByName(at).drop("__slot", "__hash")


def downsample(df: DataFrame, target: str, keys: list[str], most: float, seed: int = 7, digest: bool = False) -> DataFrame:
    """If the majority class has more than a share of most, keep int(minority * most / (1 - most)) rows of it.

    digest: choose by an MD5 of the keys, as any engine can, instead of a faster hash.
    """
    pos, neg = _class_counts(df, target)
    major, low, high = (1, neg, pos) if pos > neg else (0, pos, neg)
    if not low or high / (low + high) <= most:
        return df
    kept = keep_by_hash(df.where(F.col(target) == major), keys, int(low * most / (1 - most)), seed, digest_order(seed, *keys) if digest else None)
    return kept.unionByName(df.where(F.col(target) == 1 - major))


def upsample(df: DataFrame, target: str, least: float) -> DataFrame:
    """If the minority class has less than a share of least, add ceil(least / share) copies of its rows to them."""
    pos, neg = _class_counts(df, target)
    minor, low = (1, pos) if pos <= neg else (0, neg)
    share = low / max(1, pos + neg)
    if not low or share >= least:
        return df
    copies = math.ceil(least / share)
    times = F.when(F.col(target) == minor, F.sequence(F.lit(0), F.lit(copies))).otherwise(F.array(F.lit(0)))
    return df.withColumn("__copy", F.explode(times)).drop("__copy")


def rebalance(df: DataFrame, target: str, keys: list[str], most: float, least: float, seed: int = 7) -> DataFrame:
    return upsample(downsample(df, target, keys, most, seed), target, least)


def restore_base_rate(df: DataFrame, id: str, target: str, rate: float, seed: int = 7, digest: bool = False) -> DataFrame:
    """All negatives, and the rows of int(rate * negatives / (1 - rate)) positive ids; digest as in downsample()."""
    neg = df.where(F.col(target) == 0)
    ids = df.where(F.col(target) == 1).select(id).distinct()
    kept = keep_by_hash(ids, [id], int(rate * neg.count() / (1 - rate)), seed, digest_order(seed, id) if digest else None)
    return neg.unionByName(df.where(F.col(target) == 1).join(kept, id, "left_semi"))


def category_cohort(ids: DataFrame, id: str, category: str, keep: str, seed: int = 7) -> DataFrame:
    """The ids of one category of positives with as many negatives as keep the share of positives.

    ids: one row for each id with its category, null for a negative.  Of n negatives beside p positives, of which k have the category,
    floor(n * k / p) stay: those whose digest comes first, found on a histogram.  Positives of other categories go.
    """
    positives, of, negatives = ids.agg(F.count(category), F.count_if(F.col(category) == keep), F.count_if(F.col(category).isNull())).first()
    kept = keep_by_hash(ids.where(F.col(category).isNull()), [id], negatives * of // positives if positives else 0, order=digest_order(seed, id))
    return ids.where(F.col(category) == keep).unionByName(kept)


def restrict(panel: DataFrame, cohort: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the cohort's ids, rows of all others)."""
    own = cohort.select(id).distinct()
    return panel.join(own, id, "left_semi"), panel.join(own, id, "left_anti")


def carve_out(train: DataFrame, predict: DataFrame, id: str, share: float, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """A share of the predict ids stays to be predicted and leaves train."""
    held, _ = id_split(predict, id, share, seed)
    return train.join(held.select(id).distinct(), id, "left_anti"), held
