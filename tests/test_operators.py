"""Literal rows for the edge cases that the operators settle."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.exprs import floor_days, hash_share, ratio, to_int
from tidemark.functions.prefix import bucket_of, cumulative, grouped_quantile, row_numbers
from tidemark.operators import cleaning, densify, features, metrics, model, outliers, periods, reports, select, splits, timeline
from tidemark.roles import Duration, PanelRoles, Roles

R, P = Roles("id", "ts", "eid"), PanelRoles("id", "period")
T0 = datetime(2024, 1, 1)


def log(spark, rows):
    """rows: (id, hours after T0, value or None, reference flag)."""
    data = [(i, T0 + timedelta(hours=h), k, v, f) for k, (i, h, v, f) in enumerate(rows)]
    return spark.createDataFrame(data, "id int, ts timestamp_ntz, eid int, value double, ref_event int")


def values(df, *columns, by="eid"):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.orderBy(by).collect()]


def test_floor_days(spark):
    row = spark.sql("select timestamp_ntz'2024-01-01 23:00' a, timestamp_ntz'2024-01-02 01:00' b").select(floor_days(F.col("a"), F.col("b")), floor_days(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (0, -1)


def test_a_day_exactly_n_days_old_is_outside_the_window(spark):
    df = log(spark, [(1, 0, 1.0, 0), (1, 240, 15.0, 0), (1, 241, 2.0, 0)])
    assert values(features.trailing_days(df, R, 10, {"s": ("value", "sum")}), "s") == [1.0, 15.0, 17.0]


def test_same_day_references_open_no_next_timeline(spark):
    df = timeline.time_since_reference(log(spark, [(1, 0, None, 0), (1, 1, None, 1), (1, 5, None, 1), (1, 60, None, 1), (2, 0, None, 0)]), R)
    assert values(df, "days_to_next") == [0, 2, 2, -999, -999]
    assert values(df, "days_since_timeline") == [0, 0, 0, 0, 0]


def test_days_since_last(spark):
    df = timeline.days_since_last(log(spark, [(1, 0, 0.0, 0), (1, 30, 2.0, 0), (1, 80, 0.0, 0)]), R, {"d": F.col("value") > 0})
    assert values(df, "d") == [-1, 0, 2]


def test_collapse_takes_the_last_value_that_is_not_null(spark):
    df = log(spark, [(1, 0, 5.0, 0), (1, 1, None, 0)]).withColumn("period", F.lit(0))
    assert densify.collapse(df, R, "period", ["value"]).first()["value"] == 5.0


def panel(spark, rows):
    return spark.createDataFrame(rows, "id int, period int, n int, price double, td int, ref int")


def test_densify_and_fill(spark):
    df = densify.densify(panel(spark, [(1, 4, 2, 9.0, 0, 0), (1, 1, 1, 7.0, 5, 1), (2, 2, 3, None, -1, 0), (3, 0, 1, 1.0, 3, 0), (4, 3, 1, 1.0, 1, 0)]), P)
    got = densify.fill_gaps(df, P, "imputed", zeros=["n"], carried=["price"], since=["td"], period_days=30)
    rows = {(r["id"], r["period"]): (r["n"], r["price"], r["td"], r["imputed"]) for r in got.collect()}
    assert (1, 5) not in rows and set(k for k in rows if k[0] == 3) == {(3, 0)}
    assert rows[1, 3] == (0, 9.0, 0, 1) and rows[1, 2] == (0, 9.0, 0, 1)  # a td of 0 stays 0
    assert rows[1, 0] == (0, 7.0, 35, 1) and rows[2, 1][2] == -1 and rows[2, 0][1] is None
    assert (rows[4, 2][2], rows[4, 1][2], rows[4, 0][2]) == (31, 61, 91)
    left = {(r["id"], r["period"]) for r in densify.drop_trailing_imputed(got, P).collect()}
    assert (1, 0) not in left and (1, 2) in left
    assert {r["period"] for r in densify.drop_terminal_period(got, P, F.col("ref") == 1).where("id = 1").collect()} == {4, 3, 2}


def test_label_uses_later_rows_only(spark):
    df = densify.label_next(log(spark, [(1, 0, None, 1), (1, 24 * 10, None, 0), (1, 24 * 16, None, 1)]), R, F.col("ref_event") == 1, 7)
    assert values(df, "target") == [0, 1, 0]


def test_one_row_windows_are_zero_and_constants_do_not_raise(spark):
    df = panel(spark, [(1, 3, 2, 9.0, 0, 0), (2, 3, 2, 5.0, 0, 0), (2, 2, 2, 5.0, 0, 0), (2, 1, 2, 5.0, 0, 0), (3, 3, 2, 4.0, 0, 0), (3, 2, 2, 2.0, 0, 0), (3, 1, 2, 9.0, 0, 0)])
    got = features.rolling_rows(df, P, ["price"], 3)
    rows = {(r["id"], r["period"]): r for r in got.collect()}
    for s in ("std", "skew", "trend"):
        assert rows[1, 3][f"price_{s}_3"] == 0 and rows[2, 1][f"price_{s}_3"] == 0
    assert round(rows[3, 1]["price_skew_3"], 4) == 1.1521 and round(rows[3, 1]["price_trend_3"], 6) == 2.5
    r = {(x["a"], x["b"]): x["r"] for x in select.correlations(df, ["n", "price"]).collect()}
    assert r["n", "price"] is None


def test_outliers_with_zero_mad_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 3.0)] * 20 + [(50.0, 3.0), (None, 3.0)], "a double, b double")
    stats = {r["column"]: r for r in outliers.outlier_stats(df, ["a", "b"], 3.0).collect()}
    assert stats["a"]["mad"] == 0 and stats["a"]["n_outliers"] == 1 and stats["b"]["n_outliers"] == 0
    out = outliers.clamp(df, ["a", "b"], outliers.outlier_stats(df, ["a", "b"], 3.0)).collect()
    assert {r["a"] for r in out} == {1.0, None} and {r["b"] for r in out} == {3.0}


def test_upsampling_adds_factor_copies_and_downsampling_cuts(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(100)], "id int, target int")
    assert splits.upsample(df, "target", 0.25).where("target = 1").count() == 10 * 4
    down = splits.downsample(df, "target", ["id"], 0.7)
    assert (down.where("target = 1").count(), down.where("target = 0").count()) == (10, int(10 * 0.7 / (1 - 0.7)))
    assert sorted(r["id"] for r in down.collect()) == sorted(r["id"] for r in splits.downsample(df.repartition(7), "target", ["id"], 0.7).collect())
    assert splits.upsample(df, "target", 0.05).count() == 100 == splits.downsample(df, "target", ["id"], 0.95).count()


def test_fold_remainder_has_no_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "id int")
    got = {r["id"]: r["fold"] for r in splits.fold_assign(df, ["id"], 3).collect()}
    assert got == {i: i // 3 if i < 9 else None for i in range(11)}


def test_splits_share_no_id(spark):
    df = spark.createDataFrame([(i % 40, i) for i in range(200)], "id int, period int")
    train, held = splits.in_time_split(df, "id", "period", 0.6)
    a, b = {r["id"] for r in train.collect()}, [r["id"] for r in held.collect()]
    assert not a & set(b) and len(b) == len(set(b)) and len(a) + len(b) == 40
    rest, own = splits.carve_out(df, df.where("period > 150"), "id", 0.5)
    assert not {r["id"] for r in rest.collect()} & {r["id"] for r in own.collect()}


def test_lift_bins_cut_ranks_and_not_ntiles(spark):
    df = spark.createDataFrame([(i, i / 105, i % 2) for i in range(105)], "id int, p double, y int")
    rows = metrics.lift_bins(df, "y", "p", "id").orderBy("bin").collect()
    assert [r["n"] for r in rows] == [11, 10, 11, 10, 11, 10, 10, 11, 10, 11]
    assert rows[-1]["gain"] == 1.0 and rows[-1]["lift"] == 1.0


def test_drift_of_a_table_with_itself_is_zero(spark):
    df = spark.createDataFrame([(k, (7 * k) % 5, 0.5 * k) for k in range(24)], "visit int, shop int, spent double")
    for r in reports.drift(df, df, ["shop", "spent"]).collect():
        assert r["ks"] == 0 and all(r[f"delta_{s}"] == 0 for s in ("min", "max", "mean", "stddev", "median"))


def test_missing_periods(spark):
    # Four shops over ten weeks each: none, two, six and nine of the weeks were filled in.
    df = spark.createDataFrame([(shop, week, int(week < filled)) for shop, filled in (("a", 0), ("b", 2), ("c", 6), ("d", 9)) for week in range(10)], "shop string, week int, filled int")
    got = {r["edge"]: r["share_of_ids"] for r in reports.missing_buckets(df, "shop", "week", "filled", (0.1, 0.3, 0.6, 0.95)).collect()}
    assert got == {0.1: 0.75, 0.3: 0.5, 0.6: 0.5, 0.95: 0.0}


def test_numbers_in_text_are_compared_as_numbers(spark):
    df = spark.createDataFrame([("9.0",), ("10.0",)], "x string")
    assert reports.column_stats(df, ["x"]).first()["max"] == 10.0
    assert [r[0] for r in spark.createDataFrame([("12",), ("1x",)], "x string").select(to_int(F.col("x"))).collect()] == [12, None]


def test_week_of_new_year_and_day_periods(spark):
    df = spark.sql("select timestamp_ntz'2019-12-30' d union all select timestamp_ntz'2020-01-02' union all select timestamp_ntz'2020-01-06'")
    got = [tuple(r) for r in periods.assign_period(df, "d", "week").orderBy("d").select("period", periods.year_unit(F.col("d"), "week")).collect()]
    assert got == [(1, 202001), (1, 202001), (0, 202002)]
    assert [r["period"] for r in periods.assign_period(df, "d", "day", 2, F.lit("2020-01-05").cast("date")).orderBy("d").collect()] == [3, 1, -1]


@given(st.integers(1, 40), st.sampled_from(["day", "week", "month", "quarter", "year"]))
def test_durations(n, unit):
    d = Duration.parse(f"{n}{unit}s")
    assert (d.count, d.unit) == (n, unit) and d.in_units(unit) == n and Duration.parse("2month").in_units("week") == 8
    with pytest.raises(ValueError):
        Duration.parse(f"{unit}{n}")


def test_cumulative_equals_one_window(spark):
    df = spark.createDataFrame([(i * 37 % 101 / 7.0, i) for i in range(500)], "x double, k int")
    for down in (False, True):
        got = sorted(row_numbers(df, ["x", "k"], descending=down, buckets=9).collect(), key=lambda r: r["row_number"])
        assert [r["row_number"] for r in got] == list(range(1, 501))
        assert [(r["x"], r["k"]) for r in got] == sorted(((r["x"], r["k"]) for r in got), reverse=down)
    total = cumulative(df, ["x", "k"], {"s": F.col("k")}, buckets=5).agg(F.max("s")).first()[0]
    assert total == sum(range(500)) and cumulative(df.where("false"), ["x"], {"s": F.col("k")}).count() == 0


def test_tied_rows_are_cut_by_the_next_column(spark):
    df = spark.createDataFrame([(2.0 if i % 4 else i / 50.0, i * 7 % 1000) for i in range(1000)], "x double, k int").cache()
    for down in (False, True):
        at = df.withColumn("b", bucket_of(df, ["x", "k"], 16, down))
        assert at.groupBy("b").count().agg(F.max("count")).first()[0] < 200
        got = sorted(row_numbers(df, ["x", "k"], descending=down, buckets=16).collect(), key=lambda r: r["row_number"])
        assert [(r["x"], r["k"]) for r in got] == sorted(((r["x"], r["k"]) for r in got), reverse=down)


def test_grouped_quantile_of_large_groups(spark):
    df = spark.range(60000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100003)) / 7.0 - 900).alias("x")).cache()
    for q in (0.0, 0.003, 0.5, 0.999, 1.0):
        got = {r["g"]: r["v"] for r in grouped_quantile(df, ["g"], "x", q, "v").collect()}
        assert got == pytest.approx({r["g"]: r["v"] for r in df.groupBy("g").agg(F.percentile("x", F.lit(q)).alias("v")).collect()})


def test_grouped_quantile_equals_percentile(spark):
    df = spark.createDataFrame([(i % 3, float(i * i % 17) if i % 5 else None) for i in range(200)] + [(9, 4.0)], "g int, x double")
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        got = {r["g"]: r["v"] for r in grouped_quantile(df, ["g"], "x", q, "v", 7).collect()}
        assert got == pytest.approx({r["g"]: r["v"] for r in df.groupBy("g").agg(F.percentile("x", F.lit(q)).alias("v")).collect()})


def test_small_expressions(spark):
    row = spark.sql("select 1.0 a, 0.0 b, cast(null as double) c").select(ratio(F.col("a"), F.col("b")), ratio(F.col("b"), F.col("a")), ratio(F.col("c"), F.col("a"))).first()
    assert tuple(row) == (0.0, 0.0, 0.0)
    share = spark.range(2000).select(F.avg((hash_share(1, "id") < 0.3).cast("int"))).first()[0]
    assert 0.25 < share < 0.35


def test_cleaning(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x/y", "p(q)", "x_y")
    assert cleaning.clean_names(df, ("none",)).columns == ["x_y", "pq"]
    rows = log(spark, [(1, 0, None, 0), (1, 1, 4.0, 0), (1, 2, None, 1), (1, 3, 1.0, 0), (2, 0, 1.0, 0)])
    assert values(cleaning.fill_forward(rows, R, ["value"]), "value") == [0.0, 4.0, 4.0, 1.0, 1.0]
    assert values(cleaning.truncate_after_last(rows, R, "ref_event"), "eid") == [0, 1, 2, 4]


def test_coordinate_search_finds_the_best_of_a_separable_function():
    best, value = model.coordinate_search(lambda p: -abs(p["a"] - 3) - abs(p["b"] - 5), {"a": range(6), "b": range(9)}, {"a": 0, "b": 0})
    assert best == {"a": 3, "b": 5} and value == 0
    assert model.candidate_search([{"k": 1}, {"k": 4}, {"k": 4, "x": 0}], lambda p: p["k"]) == ({"k": 4}, 4)
