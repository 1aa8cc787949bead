"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with one key (here: equal texts) stay together.  Groups are sorted by
size and each enters the tightest shard that still has room for it, found in a
balanced tree.  Sizes are counted in classes of 12 significant bits, so what
is planned on the driver is a histogram of bounded size and not the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import spread_join
from .ranks import salted_rank
from .shared import Scratch

_PLAN = "class long, lo long, hi long, shard int"
_BITS = 12


class RoomTree:
    """AVL tree of (room, shard): the tightest shard with at least a given room in O(log shards)."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(t):
        return t[3] if t else 0

    def _node(self, left, key, right):
        return (left, key, right, 1 + max(self._height(left), self._height(right)))

    def _even(self, left, key, right):
        if self._height(left) > self._height(right) + 1:
            a, k, b, _ = left
            if self._height(a) >= self._height(b):
                return self._node(a, k, self._node(b, key, right))
            return self._node(self._node(a, k, b[0]), b[1], self._node(b[2], key, right))
        if self._height(right) > self._height(left) + 1:
            a, k, b, _ = right
            if self._height(b) >= self._height(a):
                return self._node(self._node(left, key, a), k, b)
            return self._node(self._node(left, key, a[0]), a[1], self._node(a[2], k, b))
        return self._node(left, key, right)

    def add(self, key: tuple[int, int]) -> None:
        def into(t):
            if t is None:
                return self._node(None, key, None)
            left, k, right, _ = t
            return self._even(into(left), k, right) if key < k else self._even(left, k, into(right))

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def least(t):
            return t[1] if t[0] is None else least(t[0])

        def out(t, key):
            left, k, right, _ = t
            if key < k:
                return self._even(out(left, key), k, right)
            if key > k:
                return self._even(left, k, out(right, key))
            if left is None or right is None:
                return left or right
            after = least(right)
            return self._even(left, after, out(right, after))

        self.root = out(self.root, key)

    def tightest(self, room: int) -> tuple[int, int] | None:
        t, best = self.root, None
        while t:
            if t[1][0] >= room:
                best, t = t[1], t[0]
            else:
                t = t[2]
        return best

    def widest(self) -> tuple[int, int] | None:
        t = self.root
        while t and t[2]:
            t = t[2]
        return t and t[1]


def best_fit(counts: list[tuple[int, int]], capacity: int, shards: int | None = None) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Best-fit decreasing over (size, how many), sizes descending.

    Returns rows (size, lo, hi, shard): the groups of that size with rank
    lo <= r < hi go to that shard; and the shards' loads.  Without ``shards`` a
    new one opens when none has room, which keeps their number small for a
    fixed capacity.  With it, so many are open from the start and what fits
    nowhere goes to the emptiest.  A group above capacity gets a shard alone.
    """
    tree, loads, rows = RoomTree(), [], []

    def open_shard():
        loads.append(0)
        tree.add((capacity, len(loads) - 1))

    for _ in range(shards or 0):
        open_shard()
    for size, n in counts:
        rank = 0
        while rank < n:
            at = tree.tightest(size)
            if at is None and shards is None:
                open_shard()
                at = tree.widest()
            at = at or tree.widest()
            room, shard = at
            many = min(n - rank, room // size if room >= size else 1)
            tree.remove(at)
            tree.add((room - many * size, shard))
            loads[shard] += many * size
            rows.append((size, rank, rank + many, shard))
            rank += many
    return rows, loads


def plan_shards(counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int]]:
    """Plan for a given number of shards, with the smallest capacity that best fit can keep.

    Groups above the mean load of the shards left get one each, so that a huge
    group does not set the capacity of all.
    """
    left = [(size, n) for size, n in sorted(counts.items(), reverse=True) if n]
    total = sum(s * n for s, n in left)
    rows, taken = [], 0
    while left and shards - taken > 1 and left[0][0] * (shards - taken) > total:
        size, n = left[0]
        used = sum(1 for r in rows if r[0] == size)
        rows.append((size, used, used + 1, taken))
        total, taken = total - size, taken + 1
        left[0] = (size, n - 1)
        if n == 1:
            left.pop(0)
    if left:
        done = {size: sum(1 for r in rows if r[0] == size) for size, _ in left[:1]}
        open_ = shards - taken
        low, high = -(-total // open_), -(-total // open_) + left[0][0]
        best = best_fit(left, high, open_)
        while low < high:  # best fit is not monotone in the capacity; this finds one that holds
            mid = (low + high) // 2
            got = best_fit(left, mid, open_)
            if max(got[1]) <= mid:
                best, high = got, mid
            else:
                low = mid + 1
        rows += [(s, lo + done.get(s, 0), hi + done.get(s, 0), shard + taken) for s, lo, hi, shard in best[0]]
    return rows


def size_class(size: Column) -> Column:
    """size rounded up to 12 significant bits: at most 0.05 % more, and few values."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.floor(F.log2(size.cast("double"))) - (_BITS - 1)))
    return (F.ceil(size / step) * step).cast("long")


def shard_groups(rows: DataFrame, shards: int, salts: int = 256) -> DataFrame:
    """Put rows (group_key, size, doc_id; any other columns) into shards of near equal bytes.

    Adds shard (0..shards-1) and slot, gapless from 0 in each shard.  Rows with
    equal group_key share a shard.  The driver sees the histogram of size
    classes only; a group that holds a third of all rows is summed map-side,
    dealt over many tasks for the join, and its slots are ranked in salted
    parts.  Sizes must be positive.  rows is read three times: hand in a stored table.  Its other columns stay,
    whatever their names; a shard or slot of its own is replaced.
    """
    spark = rows.sparkSession
    work = Scratch(spark, "shards")
    rows = rows.drop("shard", "slot")
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("__size"), F.count(F.lit(1)).alias("n"))
    groups = work.keep(groups.select("group_key", "n", size_class(F.col("__size")).alias("class")), "groups")
    counts = {r["class"]: r["count"] for r in groups.groupBy("class").count().collect()}
    plan = spark.createDataFrame(plan_shards(counts, shards), _PLAN)
    ranked = salted_rank(groups, ["class"], ["group_key"], "__rank", salts)
    hit = (ranked["class"] == plan["class"]) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi"))
    placed = work.keep(ranked.join(F.broadcast(plan), hit).select("group_key", "n", "shard"), "placed")
    own = rows.select(F.struct(*rows.columns).alias("__row"), "group_key", F.col("doc_id").alias("__by"), F.col("size").alias("__size"))
    sharded = work.keep(spread_join(own, placed, ["group_key"], ["__by", "__size"]).select("__row.*", "shard"), "rows")
    return salted_rank(sharded, ["shard"], ["doc_id", "size"], "slot", salts)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Documents into shards of near equal bytes; equal texts (null like empty) stay together.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, shard and slot.
    Repeated rows are rows like others; an empty table gives no rows.  Only doc_id and text are read, so
    other columns may have any name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group_key"),
    )
    return shard_groups(Scratch(docs.sparkSession, "shard-rows").keep(rows, "rows"), shards).drop("group_key")
