"""Boosting on packed rows: Spark's models from fits that share their work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, model, splits

NAMES = ["x0", "x1", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rows = spark.range(6000).repartition(3).select("id", *((F.xxhash64("id", F.lit(k)) % 1000 / 1000.0).alias(f"x{k}") for k in range(2)), F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("double")).alias("d"))
    return rows.withColumn("y", (F.col("x1") + F.coalesce("d", F.lit(0.0)) / 4 + F.xxhash64("id", F.lit(9)) % 100 / 300.0 > 0.3).cast("int")).cache()


def scores(fitted, rows):
    return np.array([r.probability for r in model.score(fitted, rows, NAMES, ["id"]).orderBy("id").collect()])


def test_shared_fits_score_as_sparks_and_go_on(rows):
    shared = boosting.Boosted()
    few, many = (model.fit_gbt(rows, NAMES, "y", trees=t, depth=3, boosted=shared) for t in (3, 12))
    assert len(shared.trees[3, 0.1]) == 12
    want, got = scores(model.fit_gbt(rows, NAMES, "y", trees=12, depth=3), rows), scores(many, rows)
    assert np.abs(want - got).mean() < 0.02 and np.corrcoef(want, got)[0, 1] > 0.99
    alone = scores(model.fit_gbt(rows, NAMES, "y", trees=3, depth=3, boosted=boosting.Boosted()), rows)
    assert np.abs(alone - scores(few, rows)).max() < 1e-9
    assert np.abs(scores(model.fit_gbt(rows, NAMES, "y", trees=3, depth=3, boosted=shared), rows) - alone).max() < 1e-9
    states = shared.states[3, 0.1].collect()  # margins before the last tree, by bins, are those of the model on the values
    ours = np.sort(np.concatenate([m for _, m, _ in states]))
    p = np.sort(scores(model.fit_gbt(rows, NAMES, "y", trees=11, depth=3, boosted=shared), rows))
    assert np.abs(1 / (1 + np.exp(-2 * ours)) - p).max() < 1e-6


def test_validations_share_packed_rows_and_trees(rows, monkeypatch):
    packs, grown = [], []
    monkeypatch.setattr(boosting, "packed", lambda *a, f=boosting.packed: packs.append(a) or f(*a))
    monkeypatch.setattr(boosting.Boosted, "_grow", lambda self, kind, f=boosting.Boosted._grow: grown.append(kind) or f(self, kind))
    shared = model.SharedFits(splits.fold_assign(rows, ["id"], 2).cache())
    got = [model.cross_validate(shared, NAMES, "y", ["id"], 2, trees=t, depth=3) for t in (4, 2, 6)]
    assert len(packs) == 2 and len(grown) == 12
    want = model.cross_validate(shared.rows, NAMES, "y", ["id"], 2, trees=6, depth=3)
    assert np.abs(np.array(got[2]) - np.array(want)).max() < 0.01 and min(want) > 0.8
    shared.free()
