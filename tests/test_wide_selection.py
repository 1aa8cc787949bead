"""Correlations of wide tables, permuted shadow columns, and what selection makes of them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import gram, select, shadows


def frame(spark, values, **more):
    names = [f"c{k:03}" for k in range(values.shape[1])]
    rows = [[None if math.isnan(x) else float(x) for x in r] for r in values]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4), names


def by_pairs(values, names):
    out = {}
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            x, y = values[:, i], values[:, j]
            both = ~np.isnan(x) & ~np.isnan(y)
            x, y = x[both] - x[both].mean() if both.any() else x[both], y[both] - y[both].mean() if both.any() else y[both]
            low = math.sqrt((x * x).sum() * (y * y).sum())
            out[a, names[j]] = (x * y).sum() / low if low > 1e-9 else None
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_pairs_with_nulls_constants_and_large_means(spark, block):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 23)) @ rng.normal(size=(23, 23)) + 1e7
    v[rng.random(v.shape) < 0.2] = np.nan
    v[:, 3], v[:, 4] = 5.0, np.nan
    v[:, 6] = v[:, 5] * 2 + 1
    df, names = frame(spark, v)
    got = {(r.a, r.b): r.r for r in gram.pair_correlations(df, names, block).collect()}
    want = by_pairs(v, names)
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert (got[k] is None) == (r is None), k
        assert r is None or abs(got[k] - r) < 1e-7, k


def test_three_hundred_columns_in_a_plan_of_fixed_size(spark):
    v = np.random.default_rng(2).normal(size=(200, 300))
    df, names = frame(spark, v)
    r = gram.pair_correlations(df, names)
    got = {(x.a, x.b): x.r for x in r.collect()}
    assert len(got) == 300 * 299 // 2
    want = np.corrcoef(v.T)
    assert all(abs(got[names[i], names[j]] - want[i, j]) < 1e-9 for i in range(0, 300, 7) for j in range(i + 1, 300, 5))
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    small = gram.pair_correlations(df.select(names[:10]), names[:10])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") - small.count("\n") <= 1 and plan.count("Aggregate") == 1 and plan.count("Join") == 0


def test_correlations_of_an_empty_table_and_one_column(spark):
    df, names = frame(spark, np.ones((1, 3)))
    assert gram.pair_correlations(df.where("false"), names).count() == 0
    assert gram.pair_correlations(df, names[:1]).count() == 0
    assert {x.r for x in gram.pair_correlations(df, names).collect()} == {None}


@pytest.mark.parametrize("n", [1, 2, 3, 120, 250, 4001, 150_000])
def test_permute_is_one_to_one_and_fixes_no_more_than_chance(n):
    got = shadows.permute(np.arange(n), n, 12345)
    assert sorted(got.tolist()) == list(range(n))
    if n > 100:
        assert (got == np.arange(n)).sum() < 8
        other = shadows.permute(np.arange(n), n, 12346)
        assert (got == other).sum() < 8 and abs(np.corrcoef(got, np.arange(n))[0, 1]) < 5 / math.sqrt(n)
        assert abs(np.corrcoef(got[1:], got[:-1])[0, 1]) < 5 / math.sqrt(n)


@pytest.mark.parametrize("n", [120, 250, 4000, 200_000])
def test_shadow_cells_come_from_other_rows(spark, n):
    df = spark.range(n).select("id", *(F.xxhash64("id", F.lit(k)).cast("double").alias(f"x{k}") for k in range(9)))
    names = [f"x{k}" for k in range(9)]
    out, added = shadows.with_shadows(df, names, 3)
    own = out.agg(*(F.count_if(F.col(c) == F.col(s)) for c, s in zip(names, added, strict=True)), *(F.count_distinct(s) for s in added)).first()
    assert max(own[:9]) < 9 and set(own[9:]) == {n} and out.count() == n
    together = out.agg(*(F.corr(added[k], added[k + 1]) for k in range(8))).first()
    assert max(map(abs, together)) < 5 / math.sqrt(n)


def test_equal_rows_nulls_and_types(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("a"), F.when(F.col("id") % 5 > 0, F.lit(1.5)).alias("b"), F.lit("x").alias("k"), F.lit(2).alias("__rank0"))
    out, added = shadows.with_shadows(df, ["a", "b"], 1)
    assert added == ["shadow_a", "shadow_b"] and dict(out.dtypes) == {**dict(df.dtypes), "shadow_a": "int", "shadow_b": "double"}
    for c in ("a", "b"):
        assert sorted(df.groupBy(c).count().collect(), key=str) == sorted(out.groupBy(f"shadow_{c}").count().collect(), key=str)
    assert shadows.with_shadows(df.where("false"), ["a"], 1)[0].count() == 0
    sizes = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in sizes) < 2 * 3000 / max(1, len(sizes)) + 200


def test_boruta_confirms_a_planted_column_and_no_noise(spark):
    rows = spark.range(1500).select(*(((F.xxhash64("id", F.lit(k)) % 1000) / 1000.0).alias(f"x{k}") for k in range(6)))
    rows = rows.withColumn("y", (F.col("x2") + 0.2 * F.col("x4") > 0).cast("int"))
    got = {r["column"]: r.decision for r in select.boruta(rows, [f"x{k}" for k in range(6)], "y", rounds=12, trees=12).collect()}
    assert got["x2"] == "confirmed" and "confirmed" not in {got[c] for c in ("x0", "x1", "x3", "x5")}
    noise = rows.withColumn("y", (F.xxhash64(F.lit(9), "x0", "x1") % 2 == 0).cast("int"))
    assert select.boruta_select(noise, ["x0", "x1", "x2"], "y", rounds=8, trees=8) == []
    assert set(select.shadow_select(rows, ["x0", "x1", "x2", "x3"], "y", rounds=1, trees=5)) == {"x2"}
