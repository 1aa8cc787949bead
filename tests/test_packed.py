"""Tree fits on packed rows: bins, shadows of bins, forests like Spark's."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import select, shadows
from tidemark.operators.packed import Packed, condensed, packed

NAMES = ["x0", "x1", "x2", "d", "none"]


@pytest.fixture(scope="module")
def rows(spark):
    rows = spark.range(6000).repartition(5).select(*((F.xxhash64("id", F.lit(k)) % 1000 / 1000.0).alias(f"x{k}") for k in range(3)), F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("double")).alias("d"), F.lit(None).cast("double").alias("none"))
    return rows.withColumn("y", (F.col("x1") + F.coalesce("d", F.lit(0.0)) / 4 > 0.3).cast("int")).cache()


def all_bins(table):
    blocks = sorted(table.blocks.collect(), key=lambda b: b.id)
    assert [len(b.y) for b in blocks] == table.sizes
    return np.concatenate([b.y for b in blocks]), np.concatenate([b.x for b in blocks], axis=1)


def test_a_summary_keeps_weights_and_few_values():
    v, w = condensed(np.arange(10_000.0), np.ones(10_000), 100)
    assert len(v) <= 101 and w.sum() == 10_000 and abs(np.cumsum(w) - v - 1).max() == 0 and max(w) < 210
    v, w = condensed(np.array([3.0, 1, 3, 3]), np.array([1.0, 2, 3, 4]), 100)
    assert v.tolist() == [1, 3] and w.tolist() == [2, 8]


def test_bins_are_even_and_few_values_have_their_own(spark, rows):
    table = packed(rows, NAMES, "y")
    y, x = all_bins(table)
    assert table.count() == 6000 and y.sum() == rows.where("y = 1").count()
    assert np.bincount(x[0], minlength=32).min() > 100 and len(table.cuts["x0"]) == 31
    assert table.cuts["d"].tolist() == [0.5, 1.5, 2.5] and np.bincount(x[3]).tolist() == [r["count"] for r in rows.na.fill(0.0).groupBy("d").count().orderBy("d").collect()]
    assert set(x[4]) == {0}
    empty = packed(rows.where("false"), NAMES, "y")
    assert empty.count() == 0 and sum(select.importances(empty, NAMES, "y", RandomForestClassifier(numTrees=2))) == 0


def test_shadows_of_bins_are_permutations_over_all_blocks(rows):
    table = packed(rows, NAMES, "y")
    got, names = shadows.with_shadows(table, NAMES[:4], 3)
    assert names == [f"shadow_{c}" for c in NAMES[:4]] and got.columns == [*NAMES[:4], *names] and len(got.sizes) > 1
    (y, x), (y2, x2) = all_bins(table), all_bins(got)
    assert (y == y2).all() and (x[:4] == x2[:4]).all()
    for k in range(4):
        assert (np.bincount(x[k]) == np.bincount(x2[k + 4])).all()
        assert abs(np.corrcoef(x[k], x2[k + 4])[0, 1]) < 0.07
    assert abs(np.corrcoef(x2[4], x2[5])[0, 1]) < 0.07
    again, other = (all_bins(shadows.with_shadows(table, NAMES[:4], s)[0])[1] for s in (3, 4))
    assert (again == x2).all() and (other[4] != x2[4]).any()


def test_a_forest_weighs_features_as_sparks(rows):
    """One tree sees every row and feature, so only the cuts differ; of many, importances agree but for chance."""
    vectors = VectorAssembler(inputCols=NAMES, outputCol="v").transform(rows.na.fill(0.0).withColumn("y", F.col("y").cast("double")))
    for trees, near in ((1, 0.02), (40, 0.08)):
        ours = RandomForestClassifier(numTrees=trees, maxDepth=4, seed=5, bootstrap=trees > 1)
        want = ours.copy().setFeaturesCol("v").setLabelCol("y").fit(vectors).featureImportances.toArray()
        got = select.importances(rows, NAMES, "y", ours)
        assert abs(sum(got) - 1) < 1e-9 and np.abs(np.array(got) - want).max() < near


def test_boruta_packs_its_rows_once(rows, monkeypatch):
    seen = []

    def importances(df, columns, *more, f=select.importances):
        seen.append(df)
        return f(df, columns, *more)

    monkeypatch.setattr(select, "importances", importances)
    got = {r["column"]: r.decision for r in select.boruta(rows, NAMES, "y", rounds=8, trees=8).collect()}
    assert got["x1"] == "confirmed" and "confirmed" not in {got[c] for c in ("x0", "x2", "none")}
    assert len(seen) > 3 and all(isinstance(df, Packed) and df.count() == 6000 for df in seen)


def test_elimination_packs_its_rows_once(rows, monkeypatch):
    seen, made = [], []

    def importances(df, columns, *more, f=select.importances):
        seen.append((df, len(columns)))
        return f(df, columns, *more)

    def once(*a, f=select.packed):
        made.append(a)
        return f(*a)

    monkeypatch.setattr(select, "importances", importances)
    monkeypatch.setattr(select, "packed", once)
    assert set(select.eliminate(rows, NAMES, "y", keep=2, trees=8)) == {"x1", "d"}
    assert [n for _, n in seen] == [5, 4, 3] and len(made) == 1 and len({id(df) for df, _ in seen}) == 1
