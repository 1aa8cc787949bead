"""Columns of the caller's own whose names the operators use inside."""

from pyspark.sql import functions as F

from tidemark.llm.packing import pack_best_fit
from tidemark.llm.shared import Scratch
from tidemark.llm.sharding import shard_groups


def test_packing_and_sharding_keep_other_columns(spark):
    names = ["lo", "hi", "sequence", "each", "place", "class", "n", "many", "rank", "offset", "shard", "slot", "sequence_id"]
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 7 + 1).alias("length"), (F.col("id") % 9 + 8).alias("size"), (F.col("id") % 2).alias("group_key"), *(F.lit(k).alias(c) for k, c in enumerate(names)))
    rows = Scratch(spark, "clash").keep(rows, "rows")
    packed = pack_best_fit(rows, 10).collect()
    assert len(packed) == 300 and all(r[c] == k for r in packed for k, c in enumerate(names) if c not in ("offset", "sequence_id"))
    assert sum(r.length for r in packed) <= 10 * len({r.sequence_id for r in packed}) and {r.offset for r in packed} <= set(range(10))
    placed = shard_groups(rows, 2).collect()
    assert len(placed) == 300 and all(r[c] == k for r in placed for k, c in enumerate(names) if c not in ("shard", "slot"))
    assert len({(r.group_key, r.shard) for r in placed}) == 2
