"""The scoring path against the training one, metrics by their definitions, groups, cohorts and small reports."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import densify, groups, metrics, outliers, reports, splits
from tidemark.operators.densify import Filling
from tidemark.roles import PanelRoles
from tidemark.sources import io

ROLES = PanelRoles("id", "period")
FILL = Filling(zeros=("n",), carried=("price",), since=("td",), dates=("day",), period_days=10)


def panel(spark):
    rows = [(1, 5, 2, 1.5, 3, "2024-01-01"), (1, 3, 1, None, 0, "2024-01-21"), (2, 6, 4, 9.0, -1, "2023-12-20"), (2, 2, 1, 8.0, 7, "2024-02-01"), (3, 0, 5, 7.0, 2, "2024-03-01"), (4, 4, 1, None, 1, "2024-01-05")]
    return spark.createDataFrame(rows, "id int, period int, n long, price double, td int, day string").withColumn("day", F.col("day").cast("timestamp"))


def test_scoring_rows_are_what_training_would_fill(spark):
    df = panel(spark)
    whole = FILL.fill(densify.densify(df, ROLES, periods=list(range(7))), ROLES)
    newest = df.groupBy("id").agg(F.min("period").alias("last"))
    want = whole.join(newest, "id").where("period <= last").drop("last")
    got = densify.scoring_panel(df, ROLES, FILL).select(*want.columns)
    assert got.dtypes == want.withColumn("price", F.col("price")).dtypes or {c for c, _ in got.dtypes} == set(want.columns)
    # The anchor itself carries the last known value, where training leaves a real row as it is.
    a, b = ({(r.id, r.period): (r.n, r.td, r.day, r.imputed, r.price if r.imputed else None) for r in x.collect()} for x in (got, want))
    assert a == b and len(a) == 4 + 3 + 1 + 5
    assert densify.scoring_panel(df, ROLES, FILL, at=3).where("id = 3").count() == 0
    assert densify.scoring_panel(df.where("false"), ROLES, FILL).count() == 0
    train = densify.training_panel(df, ROLES, FILL)
    assert {r.id: r.low for r in train.groupBy("id").agg(F.min("period").alias("low")).collect()} == {1: 3, 2: 2, 3: 0, 4: 4}


def test_offset_renumbers(spark):
    got = densify.apply_offset(panel(spark), "period", 3)
    assert sorted((r.id, r.period) for r in got.collect()) == [(1, 0), (1, 2), (2, 3), (4, 1)]


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_report_by_definition(spark, n):
    rng = np.random.default_rng(n)
    p, y = np.round(rng.random(n), 3 if n > 50 else 1), (rng.random(n) < 0.4).astype(int)
    bp = np.round(rng.random(60) ** 2, 2)
    test = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p, strict=True)] + [(None, 0.4), (1, None)], "y int, p double")
    train = spark.createDataFrame([(1, float(b)) for b in bp] + [(0, 0.1)], "y int, p double")
    r = metrics.classifier_report(test, train, "y", "p", bins=5).first()
    assert (r.tp, r.fp) == (int(((p >= 0.5) & (y == 1)).sum()), int(((p >= 0.5) & (y == 0)).sum())) and r.tp + r.fp + r.tn + r.fn == n
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        assert r.auc is None
        return
    assert abs(r.auc - np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])) < 1e-9
    assert abs(1 - r.brier_complement - np.mean((p - y) ** 2)) < 1e-9
    grid = np.unique(np.concatenate((pos, bp)))
    ks = max(abs((pos >= g).mean() - (bp >= g).mean()) for g in grid)
    assert abs(1 - r.ks_complement - ks) < 1e-9
    order = np.argsort(-p, kind="stable")
    spread = np.array([y[p == p[k]].mean() for k in order])  # ties share their positives
    cuts = [1 + b * (n - 1) // 5 for b in range(1, 6)]
    gain = [np.floor(100 * spread[:c].sum() / y.sum() + 0.5) for c in cuts]
    assert abs(r.lift_statistic - (sum(gain) - gain[-1] / 2) / 500 / (1 - y.mean())) < 0.02
    assert abs(r.lift_two_bins - (gain[0] + gain[1] / 2) / 200 / (1 - y.mean())) < 0.02


def test_column_types_at_their_edges_and_groups(spark):
    df = spark.range(3000).selectExpr("id", "id % 2 as b", "cast(id % 16 as int) as f16", "id % 17 as n17", "id % 40 as n40", "'x' as c", "cast(null as string) as empty", "if(id % 3 = 0, null, id % 2 = 0) as boo", "double('nan') as nn",
                                      "timestamp('2024-01-01') + make_dt_interval(0, 0, id) as ts", "repeat('a', cast(id % 5 as int)) as s", "uuid() as text", "if(id < 2900, 7, id) as `odd name`", "id % 90 as td_x")
    got = {r["column"]: r for r in groups.column_types(df).collect()}
    assert {c: r.kind for c, r in got.items()} == {"id": "numeric", "b": "two_valued", "f16": "factor", "n17": "numeric", "n40": "numeric", "c": "constant", "empty": "constant", "boo": "two_valued", "nn": "constant",
                                                   "ts": "date", "s": "factor", "text": "factor", "odd name": "numeric", "td_x": "numeric"}
    assert (got["f16"].n_distinct, got["n17"].n_distinct, got["empty"].n_distinct, got["boo"].n_null) == (16, None, 0, 1000)
    assert {r.kind for r in groups.column_types(df.where("false")).collect()} == {"constant"}
    g = groups.ColumnGroups.of(groups.column_types(df), exclude=("id",))
    assert g.dates == ("ts",) and g.since == ("td_x",) and set(g.binary) == {"b", "boo"} and "td_x" in g.dynamic and "td_x" not in g.carried
    kept, dropped = g.only(["b", "td_x"])
    assert kept.binary == ("b",) and kept.numeric == ("td_x",) and "s" in dropped and "ts" in dropped
    with pytest.raises(ValueError, match="nowhere"):
        g.only(["nowhere"])


def test_cohort_keeps_the_rate(spark):
    ids = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 10 < 4, "b").alias("category"))
    got = splits.category_cohort(ids, "id", "category", "a").collect()
    assert sum(r.category == "a" for r in got) == 100 and sum(r.category is None for r in got) == 600 * 100 // 400 and len(got) == 250
    assert splits.category_cohort(ids, "id", "category", "none such").count() == 0
    assert splits.category_cohort(ids.where("false"), "id", "category", "a").count() == 0


def test_candidates_zero_columns_union_and_suffixes(spark):
    df = spark.createDataFrame([(1, 0.0, None, -1.0), (2, 0.0, None, 1.0)], "id int, zero double, none double, both double")
    assert {r[0] for r in outliers.zero_columns(df, ["zero", "none", "both"]).collect()} == {"zero", "none"}
    assert outliers.candidates(["sum_n_mean", "sum_n", "td_x", "x_mean"], ("sum_",), ("_mean",), since=True) == ["sum_n_mean", "td_x"]
    both = reports.imputed_union(df, df.select("both", "id"))
    assert both.where("part = 'predict'").agg(F.sum("both"), F.count("zero")).first() == (0.0, 0)
    assert reports.suffixed(df, "_old", ["id"]).columns == ["id", "zero_old", "none_old", "both_old"]


def test_filling_for_a_horizon_spokes_and_report_files(spark, tmp_path):
    assert FILL.for_horizon("2month").period_days == 61 and FILL.period_days == 10
    figures = spark.createDataFrame([(0, 1, 0.5), (1, 2, None)], "fold int, n int, auc double")
    assert {(r.fold, r.figure, r.value) for r in metrics.spokes(figures, ["fold"], ["n", "auc"]).collect()} == {(0, "n", 1.0), (0, "auc", 0.5), (1, "n", 2.0), (1, "auc", None)}
    io.write_reports({"folds": figures, "other": figures.where("fold = 0")}, f"{tmp_path}/reports")
    index = {r.report: r.n_rows for r in spark.read.option("header", True).csv(f"{tmp_path}/reports/index").collect()}
    assert index == {"folds": "2", "other": "1"} and spark.read.option("header", True).csv(f"{tmp_path}/reports/folds").columns == figures.columns


def test_all_ways_to_split(spark):
    df = spark.range(600).selectExpr("id % 100 as id", "cast(id / 100 as int) as period", "cast(id % 7 = 0 as int) as target")
    for how in ("period", "ids", "in_time"):
        parts = splits.split_parts(df, "id", "period", how, newest=1, ref=F.col("target") == 1)
        train, validate = ({(r.id, r.period) for r in parts[k].collect()} for k in ("train", "validate"))
        assert train and validate and not train & validate
        if how != "period":
            assert not {i for i, _ in train} & {i for i, _ in validate}
        assert {r.period for r in parts["predict"].collect()} == {1}
    with pytest.raises(ValueError, match="no way"):
        splits.split_parts(df, "id", "period", "dice")
