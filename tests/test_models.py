"""Cross-validation over stored folds, scorers that are saved and refuse other columns, and attributions against brute force."""

import itertools
import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import attribution, model, splits
from tidemark.operators.attribution import Leaf
from tidemark.operators.model import Scorer

from .conftest import ROOT

COLUMNS = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select("id", *(((F.xxhash64("id", F.lit(k)) % 1000) / 1000.0).alias(f"x{k}") for k in range(4)))
    return df.withColumn("y", (F.col("x0") + F.col("x1") * F.col("x2") > 0.1).cast("int")).withColumn("x3", F.when(F.col("id") % 11 > 0, F.col("x3")))


@pytest.fixture(scope="module")
def fitted(rows):
    return model.fit_gbt(rows, COLUMNS, "y", trees=4, depth=4)


def test_fold_tables(spark, rows, tmp_path):
    df = splits.fold_assign(rows, ["id"], 4).withColumn("fold", F.when(F.col("id") != 5, F.col("fold")))
    scores, metrics = model.cross_validation(df, COLUMNS, "y", ["id"], 4, at_once=2, trees=3, depth=3)
    own = {r.id: r.fold for r in df.collect()}
    got = scores.collect()
    assert {r.id: r.fold for r in got} == {k: v for k, v in own.items() if v is not None} and len(got) == 899
    by_fold = {r.fold: r for r in metrics.collect()}
    assert sorted(by_fold) == [0, 1, 2, 3] and all(r.n_train + r.n_test == 900 for r in by_fold.values())
    for k, r in by_fold.items():
        test = [x for x in got if x.fold == k]
        assert r.n_positive == sum(x.y for x in test) == r.tp + r.fn and r.n_test == len(test) and r.auc > 0.8
        assert r.tp == sum(x.y == 1 and x.prediction == 1 for x in test)
    model.save_folds(df, f"{tmp_path}/folds")
    train, test = model.read_fold(spark, f"{tmp_path}/folds", 2)
    assert {r.id for r in test.collect()} == {k for k, v in own.items() if v == 2} and train.count() == 900 - test.count()


def test_scorer_saved_and_loaded_in_another_session(spark, rows, tmp_path):
    path = f"{tmp_path}/scorer"
    made = Scorer.fit(rows, COLUMNS, "y", trees=3, depth=3)
    made.save(path)
    made.save(path)
    want = {r.id: r.probability for r in made.score(rows, ["id"]).collect()}
    again = Scorer.load(spark, path)
    assert again.columns == made.columns and {r.id: r.probability for r in again.score(rows, ["id"]).collect()} == want
    rows.write.parquet(f"{tmp_path}/rows")
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
from tidemark.operators.model import Scorer
Scorer.load(spark, '{path}').score(spark.read.parquet('{tmp_path}/rows'), ['id']).write.parquet('{tmp_path}/scores')
"""
    env = {**os.environ, "PYTHONPATH": ROOT}
    assert subprocess.run([sys.executable, "-c", code], env=env, timeout=240, check=False, capture_output=True).returncode == 0
    assert {r.id: r.probability for r in spark.read.parquet(f"{tmp_path}/scores").collect()} == want
    for other, what in ((rows.drop("x1"), "x1: missing"), (rows.withColumn("x2", F.col("x2").cast("float")), "x2: float instead of double")):
        with pytest.raises(ValueError, match=what):
            again.score(other, ["id"])
    assert again.score(rows.select(*reversed(rows.columns)), ["id"]).count() == 900  # order does not matter, names do
    with pytest.raises(Exception, match="signature"):
        Scorer.load(spark, f"{tmp_path}/rows")


def test_attributions_add_up_to_the_margin(rows, fitted):
    scored = fitted.transform(rows.na.fill(0.0, COLUMNS)).select("id", vector_to_array("rawPrediction")[1].alias("raw"))
    got = attribution.attributions(fitted, rows, COLUMNS, ["id"])
    assert got.columns == ["id", "base", *(f"phi_{c}" for c in COLUMNS), "margin"]
    off, n = got.join(scored, "id").agg(F.max(F.abs(F.col("margin") - F.col("raw"))), F.count(F.lit(1))).first()
    assert off < 1e-9 and n == 900
    table = {r["column"]: r for r in attribution.importance_table(got, COLUMNS).collect()}
    assert table["x0"].rank == 1 and table["x3"].rank == 4 and sorted(r.rank for r in table.values()) == [1, 2, 3, 4]
    assert abs(table["x0"].mean_abs - got.agg(F.avg(F.abs("phi_x0"))).first()[0]) < 1e-12


def test_attributions_equal_all_subsets(rows, fitted):
    leaves = attribution.model_leaves(fitted)
    x = np.array([[0.0 if v is None else v for v in r[1:5]] for r in rows.limit(25).collect()])

    def known(row, s):
        """The expected margin where only the features of s are known."""
        total = 0.0
        for leaf in leaves:
            p = leaf.value
            for f, z, a, b in zip(leaf.features, leaf.shares, leaf.above, leaf.upto, strict=True):
                p *= (a < row[f] <= b) if f in s else z
            total += p
        return total

    got = attribution.attribute(leaves, x)
    for row, phi in zip(x, got, strict=True):
        for f in range(4):
            rest = [g for g in range(4) if g != f]
            want = sum(math.factorial(k) * math.factorial(3 - k) / 24 * (known(row, {*s, f}) - known(row, set(s))) for k in range(4) for s in itertools.combinations(rest, k))
            assert abs(phi[f] - want) < 1e-9
    assert abs(attribution.base_value(leaves) - known(x[0], set())) < 1e-9


def test_a_feature_twice_on_a_path_and_a_tree_without_splits():
    nodes = {0: (0, 10, 1, 2, 0, 0.5), 1: (1.0, 6, -1, -1, -1, None), 2: (0, 4, 3, 4, 0, 0.8), 3: (2.0, 1, -1, -1, -1, None), 4: (3.0, 3, -1, -1, -1, None)}
    leaves = attribution.leaves_of(nodes, 1.0)
    assert leaves[1] == Leaf(2.0, (0,), (0.1,), (0.5,), (0.8,))
    phi = attribution.attribute(leaves, np.array([[0.5], [0.7], [0.9]]))
    base = attribution.base_value(leaves)
    assert np.allclose(base + phi[:, 0], [1.0, 2.0, 3.0]) and abs(base - 1.7) < 1e-12
    assert (attribution.attribute([Leaf(5.0, (), (), (), ())], np.ones((2, 1))) == 0).all()
