"""Steps whose cost must not grow faster than their input, and plans that Spark gets wrong."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.prefix import row_numbers
from tidemark.operators import shadows, splits
from tidemark.plans import queries
from tidemark.sources.stored import dealt


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select((F.col("id") % 700).alias("k"), F.floor(F.col("id") / 700).alias("period"), F.col("id").cast("double").alias("x"))


def test_row_numbers_of_computed_columns(rows):
    """The bucket's column must not reach the filter of the small side of the join."""
    late = rows.withColumn("z", F.lead("x").over(Window.partitionBy("k").orderBy("period"))).where("z is not null")
    for df in (rows, late):
        got = [r.n for r in row_numbers(df, ["k", "period"], "n").orderBy("k", "period").collect()]
        assert got == list(range(1, df.count() + 1))
        folds = splits.fold_assign(df, ["k", "period"], 2)
        assert folds.where("fold = 1").select("x").count() == df.count() // 2


def test_a_null_is_in_the_first_bucket(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 2.0), (1.0, 3.0), (float("nan"), 4.0)], "a double, b double")
    assert [(r.n, r.b) for r in row_numbers(df, ["a", "b"], "n").orderBy("n").collect()] == [(1, 1.0), (2, 3.0), (3, 2.0), (4, 4.0)]


def test_folds_and_searches_run(spark, sf_dir):
    got = queries.coordinate_search(spark, sf_dir).collect()
    assert len(got) == 1 and got[0].trees in (2, 3) and got[0].depth in (2, 3) and 0 <= got[0].auc <= 1


def test_attributions_meet_scores_without_a_join(spark, sf_dir):
    assert "Join" not in plan(queries.attributions_add_up(spark, sf_dir))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fitted_queries_share_a_stored_table(spark, sf_dir):
    rows, names = queries._modelling(spark, sf_dir)
    assert "Window" not in plan(rows) and len(names) == 17


def test_rows_of_one_file_are_dealt_to_tasks_of_bounded_size(rows):
    got = dealt(rows.coalesce(1), 100)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.rdd.getNumPartitions() == 30 and max(sizes) < 200
    assert sorted(got.collect()) == sorted(rows.collect())


def test_shadows_move_packed_values(rows):
    """No row for each value and no table of values in a task."""
    out, _ = shadows.with_shadows(rows, ["k", "period", "x"], 5)
    assert "Aggregate" not in plan(out) and "FlatMapCoGroupsInArrow" in plan(out)
    again = shadows.numbered(rows, shadows.RANK)
    a, b = (shadows.with_shadows(again, ["k", "x"], s)[0].orderBy("x").select("shadow_x").collect() for s in (5, 6))
    assert a != b and sorted(a) == sorted(b)
