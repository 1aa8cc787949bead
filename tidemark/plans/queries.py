"""Queries over the driver's tables, one for each operator, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import plain_ascii
from ..operators import cleaning, densify, features, groups, metrics, outliers, periods, reports, select, splits, timeline
from ..roles import PanelRoles, Roles
from ..sources.stored import stored

EVENTS = Roles("user_id", "ts", "event_id")
ORDERS = Roles("o_custkey", "o_orderdate", "o_orderkey")
PANEL = PanelRoles("o_custkey", "period")
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _events(spark, d):
    return timeline.mark_reference(_read(spark, d, "events"), EVENTS, F.col("event_type") == "purchase")


def _orders(spark, d, unit="quarter"):
    return periods.assign_period(_read(spark, d, "orders"), "o_orderdate", unit)


def _panel(spark, d, unit="quarter"):
    orders = _orders(spark, d, unit).withColumn("n_orders", F.lit(1))
    return densify.collapse(orders, ORDERS, "period", ["o_totalprice", "o_orderstatus", "o_orderdate"], ["n_orders"])


def _dense(spark, d):
    """Filled quarters with a target: orders in the quarter, the last of them above 250,000."""
    p = densify.densify(_panel(spark, d), PANEL).withColumn("td", F.when(F.col("imputed") == 0, F.lit(1)))
    p = densify.fill_gaps(p, PANEL, "imputed", zeros=["n_orders"], carried=["o_totalprice"], since=["td"], period_days=91)
    return p.withColumn("target", ((F.col("n_orders") > 0) & (F.col("o_totalprice") > 250000)).cast("int"))


def _r(*names, digits=6):
    return {n: F.round(F.col(n), digits) for n in names}


# SQL building blocks.
_EV = "ev AS (SELECT *, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS ref_event, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS timeline FROM events)"
_W = "PARTITION BY user_id ORDER BY ts, event_id"


def _fd(a, b):
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000.0) AS BIGINT)"


_OPENS = f"""prior AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS start, last_value(CASE WHEN ref_event = 1 THEN ts END IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS cur,
 last_value(CASE WHEN ref_event = 1 THEN ts END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM ev),
 marked AS (SELECT *, CASE WHEN ref_event = 1 AND (prev IS NULL OR {_fd('prev', 'ts')} > 0) THEN ts END AS opens FROM prior),
 td AS (SELECT *, {_fd('start', 'ts')} AS days_since_start, {_fd('coalesce(cur, start)', 'ts')} AS days_since_timeline,
 coalesce({_fd('ts', f'first_value(opens IGNORE NULLS) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)')}, -999) AS days_to_next FROM marked)"""


def _unit(unit):
    return {"month": "(year(o_orderdate) * 12 + month(o_orderdate))", "quarter": "(year(o_orderdate) * 4 + quarter(o_orderdate))"}[unit]


def _ord(unit="quarter"):
    return f"ord AS (SELECT *, CAST((SELECT max({_unit(unit)}) FROM orders) - {_unit(unit)} AS INTEGER) AS period FROM orders)"


_PAN = "pan AS (SELECT o_custkey, period, last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS o_totalprice, last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS o_orderstatus, max(o_orderdate) AS o_orderdate, CAST(count(*) AS BIGINT) AS n_orders FROM ord GROUP BY ALL)"
_DENSE = """spine AS (SELECT f.o_custkey, u.period FROM (SELECT o_custkey, max(period) AS first FROM pan GROUP BY 1) f JOIN (SELECT DISTINCT period FROM pan) u ON u.period <= f.first),
 dense AS (SELECT s.o_custkey, s.period, p.o_totalprice, p.n_orders, CASE WHEN p.n_orders IS NULL THEN 1 ELSE 0 END AS imputed FROM spine s LEFT JOIN pan p USING (o_custkey, period)),
 runs AS (SELECT *, sum(1 - imputed) OVER (PARTITION BY o_custkey ORDER BY period DESC ROWS UNBOUNDED PRECEDING) AS run FROM dense),
 filled AS (SELECT o_custkey, period, imputed, coalesce(n_orders, 0) AS n_orders, first_value(o_totalprice) OVER g AS o_totalprice, 1 + 91 * (row_number() OVER g - 1) AS td FROM runs WINDOW g AS (PARTITION BY o_custkey, run ORDER BY period DESC)),
 full_ AS (SELECT *, CASE WHEN n_orders > 0 AND o_totalprice > 250000 THEN 1 ELSE 0 END AS target FROM filled)"""
_FULL = f"WITH {_ord()}, {_PAN}, {_DENSE}"


# ---- reference events, timelines, time since ----
@query(f"WITH {_EV} SELECT event_id, ref_event, timeline FROM ev")
def timeline_mark(spark, d):
    return _events(spark, d).select("event_id", "ref_event", "timeline")


@query(f"WITH {_EV}, {_OPENS} SELECT event_id, days_since_start, days_since_timeline FROM td")
def days_since_ref(spark, d):
    return timeline.time_since_reference(_events(spark, d), EVENTS).select("event_id", "days_since_start", "days_since_timeline")


@query(f"WITH {_EV}, {_OPENS} SELECT event_id, days_to_next FROM td")
def days_to_next_ref(spark, d):
    return timeline.time_since_reference(_events(spark, d), EVENTS).select("event_id", "days_to_next")


def _since_sql(cond):
    return f"coalesce({_fd(f'last_value(CASE WHEN {cond} THEN ts END IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING)', 'ts')}, -1)"


@query("SELECT event_id, {} AS td_click, {} AS td_large FROM events".format(_since_sql("event_type = 'click'"), _since_sql("value > 100")))
def td_last_by_type(spark, d):
    conditions = {"td_click": F.col("event_type") == "click", "td_large": F.col("value") > 100}
    return timeline.days_since_last(_read(spark, d, "events"), EVENTS, conditions).select("event_id", *conditions)


@query(f"SELECT event_id, round(sum(value) OVER ({_W} ROWS UNBOUNDED PRECEDING), 4) AS expanding_value FROM events")
def expanding_sum(spark, d):
    return timeline.running_sums(_read(spark, d, "events"), EVENTS, ["value"]).select("event_id", F.round("expanding_value", 4).alias("expanding_value"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(l_discount, 0) + coalesce(l_tax, 0), 6) AS rates, round(coalesce(l_quantity, 0) + coalesce(l_extendedprice, 0), 4) AS amounts FROM lineitem")
def row_sums(spark, d):
    out = timeline.row_sums(_read(spark, d, "lineitem"), {"rates": ["l_discount", "l_tax"], "amounts": ["l_quantity", "l_extendedprice"]})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("rates", 6).alias("rates"), F.round("amounts", 4).alias("amounts"))


# ---- cleaning and filters ----
@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 150)")
def ref_semijoin(spark, d):
    return cleaning.keep_ids_with(_read(spark, d, "events"), EVENTS, (F.col("event_type") == "purchase") & (F.col("value") > 150)).select("event_id", "user_id")


@query(f"WITH {_EV}, {_OPENS} SELECT event_id, timeline, days_to_next FROM td WHERE timeline > 0 AND event_type NOT IN ('error') AND (days_to_next < 0 OR ref_event = 1 OR days_to_next > 1)")
def event_filters(spark, d):
    return cleaning.event_filters(timeline.time_since_reference(_events(spark, d), EVENTS), "timeline", "event_type", ("error",), "ref_event", "days_to_next").select("event_id", "timeline", "days_to_next")


@query(f"WITH {_EV}, {_OPENS}, a AS (SELECT * FROM td WHERE NOT (ref_event = 1 AND days_since_start = 0)), b AS (SELECT *, row_number() OVER ({_W}) AS n FROM a) SELECT event_id FROM b WHERE NOT (n = 1 AND ref_event = 1 AND timeline = 1)")
def first_day_references(spark, d):
    return cleaning.drop_first_day_references(timeline.time_since_reference(_events(spark, d), EVENTS), EVENTS, "ref_event", "days_since_start", "timeline").select("event_id")


@query(f"WITH {_EV}, a AS (SELECT *, max(ref_event) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead, max(ref_event) OVER (PARTITION BY user_id) AS anyref FROM ev) SELECT event_id FROM a WHERE ahead = 1 OR anyref = 0")
def truncate_after_last_ref(spark, d):
    return cleaning.truncate_after_last(_events(spark, d), EVENTS, "ref_event").select("event_id")


@query(f"WITH {_EV}, {_OPENS}, k AS (SELECT user_id FROM td WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1 HAVING max(days_since_start) > 17) SELECT event_id, days_since_start FROM td WHERE user_id IN (SELECT user_id FROM k)")
def short_journeys(spark, d):
    rows = timeline.time_since_reference(_events(spark, d), EVENTS)
    return cleaning.drop_short_journeys(rows, EVENTS, "days_since_start", 17, F.lit("2024-01-20").cast("timestamp_ntz")).select("event_id", "days_since_start")


@query(f"WITH {_EV}, a AS (SELECT *, max(ts) OVER (PARTITION BY user_id) AS top, max(ref_event) OVER (PARTITION BY user_id) AS anyref FROM ev) SELECT event_id FROM a WHERE NOT (anyref = 1 AND ts = top)")
def drop_last_date(spark, d):
    return cleaning.drop_terminal_events(_events(spark, d), EVENTS, "ref_event").select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT min(o_orderdate) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-08-01') - INTERVAL 11 MONTH")
def sparse_past(spark, d):
    return cleaning.drop_sparse_past(_read(spark, d, "orders"), "o_orderdate", F.lit("2001-08-01").cast("date"), 2, 11).select("o_orderkey")


@query("SELECT event_id, value FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-05'")
def date_filters(spark, d):
    rows = cleaning.until(_read(spark, d, "events"), "ts", F.lit("2024-01-20").cast("timestamp_ntz"))
    return cleaning.since(rows, "ts", F.lit("2024-01-05").cast("timestamp_ntz")).select("event_id", "value")


@query(f"WITH e AS (SELECT *, CASE WHEN event_type = 'view' THEN value END AS seen FROM events) SELECT event_id, round(coalesce(last_value(seen IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING), 0), 6) AS seen, round(CASE WHEN value = 0 THEN 0 ELSE ln(value) END, 6) AS log_value FROM e")
def fill_and_log(spark, d):
    rows = _read(spark, d, "events").withColumn("seen", F.when(F.col("event_type") == "view", F.col("value")))
    rows = cleaning.log_transform(cleaning.fill_forward(rows, EVENTS, ["seen"]), ["value"])
    return rows.select("event_id", F.round("seen", 6).alias("seen"), F.round("value", 6).alias("log_value"))


@query("SELECT c_custkey, regexp_replace(c_name, '[^\\x00-\\x7F]', '', 'g') AS name, c_acctbal AS balance FROM customer WHERE c_acctbal >= 0")
def clean_columns(spark, d):
    rows = _read(spark, d, "customer").withColumnRenamed("c_acctbal", "bal(ance)").withColumn("bal[ance]", F.lit(1))
    rows = cleaning.drop_negative(cleaning.clean_names(rows, ("c_nationkey", "c_mktsegment")), "balance")
    return rows.withColumn("c_name", plain_ascii(F.col("c_name"))).withColumnRenamed("c_name", "name")


@query("SELECT o_orderkey, o_custkey, CAST(s.qty AS DOUBLE) AS l_quantity FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) s ON l_orderkey = o_orderkey")
def side_table(spark, d):
    orders = _read(spark, d, "orders")
    side = _read(spark, d, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    return cleaning.side_table_sums(orders, side, Roles("o_orderkey", "o_orderdate", "o_orderkey"), ["l_quantity"]).select("o_orderkey", "o_custkey", "l_quantity")


# ---- periods ----
@query(f"WITH {_ord('month')} SELECT o_orderkey, period, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS year_unit FROM ord")
def period_assign_month(spark, d):
    return _orders(spark, d, "month").select("o_orderkey", "period", periods.year_unit(F.col("o_orderdate"), "month").alias("year_unit"))


@query("WITH u AS (SELECT event_id, CAST(floor((epoch_us(ts) / 86400000000.0 - 4) / 7) AS INTEGER) AS w, isoyear(ts) * 100 + weekofyear(ts) AS yw FROM events) SELECT event_id, CAST(CASE WHEN w > e THEN -1 ELSE (e - w) // 2 END AS INTEGER) AS period, CAST(yw AS INTEGER) AS year_unit FROM u, (SELECT CAST(floor((epoch_us(TIMESTAMP '2024-01-24') / 86400000000.0 - 4) / 7) AS INTEGER) AS e)")
def period_assign_two_weeks(spark, d):
    rows = periods.assign_period(_read(spark, d, "events"), "ts", "week", 2, F.lit("2024-01-24").cast("date"))
    return rows.select("event_id", "period", periods.year_unit(F.col("ts"), "week").cast("int").alias("year_unit"))


@query(
    f"WITH c AS (SELECT {_unit('month')} AS unit, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT unnest(range((SELECT min(unit) FROM c), (SELECT max(unit) FROM c) + 1)) AS unit) "
    "SELECT CAST(unit AS INTEGER) AS unit, CAST((SELECT max(unit) FROM c) - unit AS INTEGER) AS period, coalesce(n, 0) AS n FROM s LEFT JOIN c USING (unit)"
)
def period_calendar(spark, d):
    return periods.calendar_of(_read(spark, d, "orders"), "o_orderdate", "month")


@query(f"SELECT event_id, CASE WHEN value > 100 THEN 1 ELSE 0 END AS ref_event, CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS timeline, value AS expanding_value FROM events")
def timeline_from_indicator(spark, d):
    rows = _read(spark, d, "events").withColumn("ended", F.when(F.col("value") > 100, 1))
    return timeline.as_running(timeline.mark_indicator(rows, EVENTS, "ended"), ["value"]).select("event_id", "ref_event", "timeline", "expanding_value")


@query(f"WITH {_ord()}, {_PAN} SELECT o_custkey, period, o_totalprice, o_orderstatus, n_orders FROM pan")
def period_collapse(spark, d):
    return _panel(spark, d).select("o_custkey", "period", "o_totalprice", "o_orderstatus", "n_orders")


@query(f"{_FULL} SELECT o_custkey, period, imputed FROM full_")
def densify_periods(spark, d):
    return densify.densify(_panel(spark, d), PANEL).select("o_custkey", "period", "imputed")


@query(f"{_FULL} SELECT o_custkey, period, imputed, n_orders, o_totalprice, td, target FROM full_")
def densify_fill(spark, d):
    return _dense(spark, d).select("o_custkey", "period", "imputed", "n_orders", "o_totalprice", F.col("td").cast("long").alias("td"), "target")


@query(f"WITH {_EV} SELECT event_id, CASE WHEN {_fd('ts', f'first_value(CASE WHEN ref_event = 1 THEN ts END IGNORE NULLS) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)')} < 7 THEN 1 ELSE 0 END AS target FROM ev")
def label_next_event(spark, d):
    return densify.label_next(_events(spark, d), EVENTS, F.col("ref_event") == 1, 7).select("event_id", "target")


@query(f"WITH n AS (SELECT o_orderkey, last_day(o_orderdate) AS month_end, first_value(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM orders) SELECT o_orderkey, CASE WHEN {_fd('CAST(month_end AS TIMESTAMP)', 'nxt')} < 60 THEN 1 ELSE 0 END AS target FROM n")
def label_from_period_end(spark, d):
    rows = _read(spark, d, "orders")
    return densify.label_next(rows, ORDERS, F.col("o_orderpriority") == "1-URGENT", 60, start=F.last_day("o_orderdate").cast("timestamp_ntz")).select("o_orderkey", "target")


@query(f"{_FULL} SELECT o_custkey, period FROM (SELECT *, max(1 - imputed) OVER (PARTITION BY o_custkey ORDER BY period DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS re FROM full_) WHERE re = 1")
def drop_trailing_imputed(spark, d):
    return densify.drop_trailing_imputed(_dense(spark, d), PANEL).select("o_custkey", "period")


@query(f"{_FULL} SELECT o_custkey, period FROM (SELECT *, coalesce(min(CASE WHEN target = 1 THEN period END) OVER (PARTITION BY o_custkey), -999) AS re FROM full_) WHERE period > re")
def drop_terminal_period(spark, d):
    return densify.drop_terminal_period(_dense(spark, d), PANEL, F.col("target") == 1).select("o_custkey", "period")


@query(f"WITH {_ord('month')} SELECT min(period) AS label_offset FROM (SELECT period, max(o_orderdate) AS dd FROM ord GROUP BY 1) WHERE {_fd('dd', '(SELECT max(o_orderdate) FROM orders)')} >= 60")
def label_offset(spark, d):
    rows = _orders(spark, d, "month")
    last = rows.agg(F.max("o_orderdate")).first()[0]
    return densify.label_offset(rows, "o_orderdate", "period", F.lit(last).cast("timestamp_ntz"), 60)


# ---- window features ----
_T7 = "(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 604799999999 MICROSECONDS PRECEDING AND CURRENT ROW)"


@query(f"SELECT event_id, round(sum(value) OVER {_T7}, 4) AS sum_7d, max(value) OVER {_T7} AS max_7d, round(quantile_cont(value, 0.5) OVER {_T7}, 6) AS median_7d, count(value) OVER {_T7} AS count_7d FROM events")
def roll_time(spark, d):
    out = features.trailing_days(_read(spark, d, "events"), EVENTS, 7, {"sum_7d": ("value", "sum"), "max_7d": ("value", "max"), "median_7d": ("value", "median"), "count_7d": ("value", "count")})
    return out.select("event_id", F.round("sum_7d", 4).alias("sum_7d"), "max_7d", F.round("median_7d", 6).alias("median_7d"), "count_7d")


@query(f"WITH {_ord()} SELECT o_custkey, period, o_orderkey FROM ord QUALIFY row_number() OVER (PARTITION BY o_custkey, period ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def last_in_period(spark, d):
    return features.last_in_period(_orders(spark, d), ORDERS, "period").select("o_custkey", "period", "o_orderkey")


_R6 = "(PARTITION BY o_custkey ORDER BY period DESC ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


def _roll_sql(expr):
    return f"{_FULL}, num AS (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY period DESC) AS DOUBLE) AS pos, CAST(n_orders AS DOUBLE) AS x FROM full_) SELECT o_custkey, period, {expr} FROM num"


def _rolled(spark, d, *stats):
    rows = _dense(spark, d).withColumn("n_orders", F.col("n_orders").cast("double"))
    out = features.rolling_rows(rows, PANEL, ["n_orders"], 6, stats)
    return out.select("o_custkey", "period", *(F.round(f"n_orders_{s}_6", 7 if s == "skew" else 6).alias(s) for s in stats))


@query(_roll_sql(f"round(avg(x) OVER {_R6}, 6) AS mean, round(coalesce(stddev_samp(x) OVER {_R6}, 0), 6) AS std, min(x) OVER {_R6} AS min, max(x) OVER {_R6} AS max, sum(x) OVER {_R6} AS sum, quantile_cont(x, 0.5) OVER {_R6} AS median"))
def roll_rows(spark, d):
    return _rolled(spark, d, "mean", "std", "min", "max", "sum", "median")


@query(_roll_sql(f"round(CASE WHEN count(x) OVER {_R6} < 2 THEN 0 ELSE coalesce(regr_slope(x, pos) OVER {_R6}, 0) END, 6) AS trend"))
def roll_rows_trend(spark, d):
    return _rolled(spark, d, "trend")


@query(_roll_sql(f"round(CASE WHEN count(x) OVER {_R6} < 3 OR max(x) OVER {_R6} = min(x) OVER {_R6} THEN 0 ELSE skewness(x) OVER {_R6} END, 7) AS skew"))
def roll_rows_skew(spark, d):
    return _rolled(spark, d, "skew")


_P = "(PARTITION BY o_custkey ORDER BY period DESC)"


@query(f"{_FULL} SELECT o_custkey, period, coalesce(lag(n_orders, 1) OVER {_P}, 0) AS n_orders_lag_1, coalesce(lag(n_orders, 2) OVER {_P}, 0) AS n_orders_lag_2 FROM full_")
def lag_features(spark, d):
    return features.lags(_dense(spark, d), PANEL, ["n_orders"], 2).select("o_custkey", "period", "n_orders_lag_1", "n_orders_lag_2")


@query(f"{_FULL} SELECT o_custkey, period, coalesce(lead(n_orders, 2) OVER {_P}, 0) AS ahead FROM full_")
def shift_features(spark, d):
    return features.shift(_dense(spark, d), PANEL, ["n_orders"], -2).select("o_custkey", "period", F.col("n_orders_shift_-2").alias("ahead"))


@query(f"{_FULL} SELECT o_custkey, period, round(coalesce(o_totalprice - lag(o_totalprice) OVER {_P}, 0), 4) AS diff, round(coalesce((o_totalprice - lag(o_totalprice) OVER {_P}) / nullif(lag(o_totalprice) OVER {_P}, 0), 0), 6) AS rate FROM full_")
def diff_and_rate(spark, d):
    rows = features.rates(features.differences(_dense(spark, d), PANEL, ["o_totalprice"]), PANEL, ["o_totalprice"])
    return rows.select("o_custkey", "period", F.round("o_totalprice_diff", 4).alias("diff"), F.round("o_totalprice_rate", 6).alias("rate"))


@query("SELECT o_orderkey, " + ", ".join(f"round({f}(({v} - 1) * (2 * pi() / {n})), 6) AS {k}_{f}" for k, v, n in (("month", "month(o_orderdate)", 12), ("quarter", "quarter(o_orderdate)", 4), ("week", "weekofyear(o_orderdate)", 53), ("weekday", "isodow(o_orderdate)", 7)) for f in ("sin", "cos")) + " FROM orders")
def cyclical_features(spark, d):
    names = [f"{k}_{f}" for k in ("month", "quarter", "week", "weekday") for f in ("sin", "cos")]
    return features.cyclical(_read(spark, d, "orders"), "o_orderdate").select("o_orderkey", *(F.round(n, 6).alias(n) for n in names))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / l_quantity, 6) AS unit_price, round(CASE WHEN l_discount = 0 THEN 0 ELSE l_tax / l_discount END, 6) AS tax_share FROM lineitem")
def unit_ratios(spark, d):
    rows = features.ratios(_read(spark, d, "lineitem"), {"unit_price": ("l_extendedprice", "l_quantity"), "tax_share": ("l_tax", "l_discount")})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round("unit_price", 6).alias("unit_price"), F.round("tax_share", 6).alias("tax_share"))


@query("SELECT 'o_orderpriority' AS \"column\", count(DISTINCT o_orderpriority) AS n_distinct, 0 AS is_binary FROM orders UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), CASE WHEN count(DISTINCT o_orderstatus) = 2 THEN 1 ELSE 0 END FROM orders")
def column_groups(spark, d):
    return features.column_groups(_read(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])


#: Digits to which each enriched feature is compared, by its ending.
_ENRICHED = {f"{c}_{s}": n for c, wide in (("n_orders", 0), ("o_totalprice", 2)) for s, n in (("mean_6", 6 - wide), ("std_6", 6 - wide), ("skew_6", 6 - wide), ("trend_6", 6 - wide), ("lag_1", 4), ("lag_2", 4), ("diff", 4))}


def _enriched_sql(c):
    return f"""round(avg({c}) OVER {_R6}, {_ENRICHED[f'{c}_mean_6']}) AS {c}_mean_6, round(coalesce(stddev_samp({c}) OVER {_R6}, 0), {_ENRICHED[f'{c}_std_6']}) AS {c}_std_6,
 round(CASE WHEN count({c}) OVER {_R6} < 3 OR max({c}) OVER {_R6} = min({c}) OVER {_R6} THEN 0 ELSE skewness({c}) OVER {_R6} END, {_ENRICHED[f'{c}_skew_6']}) AS {c}_skew_6,
 round(CASE WHEN count({c}) OVER {_R6} < 2 THEN 0 ELSE coalesce(regr_slope({c}, pos) OVER {_R6}, 0) END, {_ENRICHED[f'{c}_trend_6']}) AS {c}_trend_6,
 round(coalesce(lag({c}, 1) OVER {_P}, 0), 4) AS {c}_lag_1, round(coalesce(lag({c}, 2) OVER {_P}, 0), 4) AS {c}_lag_2, round(coalesce({c} - lag({c}) OVER {_P}, 0), 4) AS {c}_diff"""


def _enriched(spark, d):
    rows = _dense(spark, d).withColumn("n_orders", F.col("n_orders").cast("double"))
    return features.enrich(rows, PANEL, ["n_orders", "o_totalprice"], 6, 2)


@query(f"{_FULL}, num AS (SELECT * REPLACE (CAST(n_orders AS DOUBLE) AS n_orders), CAST(row_number() OVER {_P} AS DOUBLE) AS pos FROM full_) SELECT o_custkey, period, target, n_orders, o_totalprice, CAST(td AS BIGINT) AS td, {_enriched_sql('n_orders')}, {_enriched_sql('o_totalprice')} FROM num")
def enrich_panel(spark, d):
    rounded = [F.round(c, n).alias(c) for c, n in _ENRICHED.items()]
    return _enriched(spark, d).select("o_custkey", "period", "target", "n_orders", "o_totalprice", F.col("td").cast("long").alias("td"), *rounded)


# ---- outliers ----
_LONG = "lng AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME \"column\" VALUE x)"
_OUT = f"""WITH {_LONG}, a AS (SELECT "column", median(x) AS med, avg(x) AS mu FROM lng GROUP BY 1), b AS (SELECT l."column", any_value(med) AS med, median(abs(x - med)) AS mad, avg(abs(x - mu)) AS dev FROM lng l JOIN a USING ("column") GROUP BY 1),
 z AS (SELECT l."column", x, med, mad, dev, CASE WHEN mad > 0 THEN abs(0.6745 * (x - med) / mad) WHEN dev > 0 THEN abs(0.7979 * (x - med) / dev) ELSE 0 END AS z FROM lng l JOIN b USING ("column")),
 st AS (SELECT "column", any_value(med) AS median, any_value(mad) AS mad, any_value(dev) AS mean_dev, min(CASE WHEN z <= 1.5 THEN x END) AS low, max(CASE WHEN z <= 1.5 THEN x END) AS high, count(CASE WHEN z > 1.5 THEN 1 END) AS n_outliers FROM z GROUP BY 1)"""


@query(f'{_OUT} SELECT "column", round(median, 4) AS median, round(mad, 4) AS mad, round(mean_dev, 4) AS mean_dev, low, high, n_outliers FROM st')
def outlier_stats(spark, d):
    return outliers.outlier_stats(_read(spark, d, "lineitem"), NUMBERS, 1.5).withColumns(_r("median", "mad", "mean_dev", digits=4))


@query(f"""{_OUT} SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f"greatest(least({c}, (SELECT high FROM st WHERE \"column\" = '{c}')), (SELECT low FROM st WHERE \"column\" = '{c}')) AS {c}" for c in NUMBERS)} FROM lineitem""")
def outlier_clamp(spark, d):
    rows = _read(spark, d, "lineitem")
    return outliers.clamp(rows, NUMBERS, outliers.outlier_stats(rows, NUMBERS, 1.5)).select("l_orderkey", "l_linenumber", "l_partkey", *NUMBERS)


# ---- splits and sampling ----
@query(f"{_FULL} SELECT o_custkey, period, CASE WHEN period > 3 THEN 'train' ELSE 'validate' END AS part FROM full_")
def split_period(spark, d):
    train, validate = splits.period_split(_dense(spark, d), "period", 3)
    return train.select("o_custkey", "period", F.lit("train").alias("part")).unionByName(validate.select("o_custkey", "period", F.lit("validate").alias("part")))


@query(f"{_FULL} SELECT o_custkey, period FROM full_ WHERE period = 2 AND o_custkey NOT IN (SELECT o_custkey FROM full_ WHERE period = 2 AND target = 1)")
def predict_split(spark, d):
    return splits.predict_split(_dense(spark, d), "o_custkey", "period", 2, F.col("target") == 1).select("o_custkey", "period")


@query("SELECT o_orderkey, CAST(CASE WHEN f < 4 THEN f END AS INTEGER) AS fold FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // ((SELECT count(*) FROM orders) // 4) AS f FROM orders)")
def fold_assign(spark, d):
    return splits.fold_assign(_read(spark, d, "orders"), ["o_custkey", "o_orderkey"], 4).select("o_orderkey", "fold")


@query("WITH f AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // ((SELECT count(*) FROM orders) // 4) AS f FROM orders) SELECT o_orderkey, CASE WHEN f = 1 THEN 'test' ELSE 'train' END AS part FROM f")
def fold_semi_anti(spark, d):
    rows = splits.fold_assign(_read(spark, d, "orders"), ["o_custkey", "o_orderkey"], 4)
    train, test = splits.fold_parts(rows, ["o_custkey", "o_orderkey"], rows.where("fold = 1"))
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(test.select("o_orderkey", F.lit("test").alias("part")))


@query(f"{_FULL} SELECT o_custkey, period, CASE WHEN period > 3 OR period = 3 THEN 'train' ELSE 'test' END AS part FROM full_ WHERE period <= 12")
def validation_assembly(spark, d):
    train, validate = splits.period_split(_dense(spark, d), "period", 3)
    a, b = splits.validation_parts(train, validate, "period", 12, 2)
    return a.select("o_custkey", "period", F.lit("train").alias("part")).unionByName(b.select("o_custkey", "period", F.lit("test").alias("part")))


_UP = "(SELECT count(*) FILTER (o_orderpriority = '1-URGENT') / count(*) FROM orders)"


@query(f"SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL SELECT o_orderkey FROM orders, (SELECT unnest(generate_series(0, CAST(ceil(0.45 / {_UP}) AS BIGINT)))) WHERE o_orderpriority = '1-URGENT'")
def upsample(spark, d):
    rows = _read(spark, d, "orders").withColumn("target", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return splits.upsample(rows, "target", 0.45).select("o_orderkey")


@query("WITH c AS (SELECT count(*) FILTER (o_orderpriority = '1-URGENT') AS p, count(*) AS n FROM orders) SELECT p AS positives, least(n - p, CAST(floor(p * 0.7::DOUBLE / (1 - 0.7::DOUBLE)) AS BIGINT)) AS negatives FROM c")
def downsample_counts(spark, d):
    rows = _read(spark, d, "orders").withColumn("target", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return splits.downsample(rows, "target", ["o_orderkey"], 0.7).agg(F.count_if(F.col("target") == 1).alias("positives"), F.count_if(F.col("target") == 0).alias("negatives"))


@query("WITH p AS (SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS t FROM orders GROUP BY 1) SELECT count(*) FILTER (t = 0) AS negatives, CAST(floor(0.2::DOUBLE * count(*) FILTER (t = 0) / (1 - 0.2::DOUBLE)) AS BIGINT) AS positives FROM p")
def base_rate_counts(spark, d):
    rows = _read(spark, d, "orders").groupBy("o_custkey").agg(F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("target"))
    return splits.restore_base_rate(rows, "o_custkey", "target", 0.2).agg(F.count_if(F.col("target") == 0).alias("negatives"), F.count_if(F.col("target") == 1).alias("positives"))


@query("SELECT count(DISTINCT o_custkey) AS ids, CAST(0 AS BIGINT) AS shared, CAST(1 AS BIGINT) AS rows_per_held_id FROM orders")
def random_split_checks(spark, d):
    """Which ids a hash picks is its own affair; that parts are disjoint and whole is not."""
    train, held = splits.in_time_split(_read(spark, d, "orders"), "o_custkey", "o_orderkey", 0.7)
    both = train.select("o_custkey", F.lit(0).alias("h")).unionByName(held.select("o_custkey", F.lit(1).alias("h")))
    per = both.groupBy("o_custkey").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.sum("h").alias("held"))
    return per.agg(F.count(F.lit(1)).alias("ids"), F.count_if(F.col("low") != F.col("high")).alias("shared"), F.max("held").alias("rows_per_held_id"))


# ---- feature filters ----
@query(f'WITH {_LONG} SELECT "column", round(quantile_cont(x, 0.1), 6) AS value, CASE WHEN quantile_cont(x, 0.1) > 0 THEN 1 ELSE 0 END AS kept FROM lng GROUP BY 1')
def sparse_columns(spark, d):
    return select.sparse_columns(_read(spark, d, "lineitem"), NUMBERS, 0.1).withColumns(_r("value"))


@query(f'WITH {_LONG} SELECT "column", count(DISTINCT x) AS n_distinct, 1 AS kept FROM lng GROUP BY 1')
def distinct_columns(spark, d):
    return select.distinct_columns(_read(spark, d, "lineitem"), NUMBERS)


@query(f'WITH {_LONG}, c AS (SELECT "column", x, count(*) AS n FROM lng GROUP BY ALL) SELECT "column", round(max(n) / sum(n), 6) AS mode_share, CASE WHEN max(n) / sum(n) < 0.1 THEN 1 ELSE 0 END AS kept FROM c GROUP BY 1')
def low_variance(spark, d):
    return select.low_variance(_read(spark, d, "lineitem"), NUMBERS, 0.1).withColumns(_r("mode_share"))


_PAIRS = [(a, b) for k, a in enumerate(sorted(NUMBERS)) for b in sorted(NUMBERS)[k + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS r FROM lineitem" for a, b in _PAIRS))
def correlations(spark, d):
    return select.correlations(_read(spark, d, "lineitem"), NUMBERS).withColumns(_r("r", digits=5))


_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM lineitem" for a, b in _PAIRS)


@query(f'WITH p AS ({_CORR}), v AS (SELECT unnest({sorted(NUMBERS)}) AS c) SELECT c AS "column", CASE WHEN coalesce(max(r), 0) > 0.5 THEN 0 ELSE 1 END AS kept FROM v LEFT JOIN p ON p.b = v.c GROUP BY c')
def correlated_columns(spark, d):
    return select.correlated_columns(_read(spark, d, "lineitem"), NUMBERS, 0.5)


# ---- reports ----
_STATS = "count(x) AS n, round(min(x), 4) AS min, round(max(x), 4) AS max, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS stddev, round(median(x), 4) AS median"
_S = ("min", "max", "mean", "stddev", "median")


@query(f'WITH {_LONG} SELECT "column", {_STATS} FROM lng GROUP BY 1')
def column_stats(spark, d):
    return reports.column_stats(_read(spark, d, "lineitem"), NUMBERS).withColumns(_r(*_S, digits=4))


_SPLIT = "WITH a AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), b AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"


def _two(spark, d):
    rows, edge = _read(spark, d, "lineitem"), F.lit("1998-01-01").cast("timestamp_ntz")
    return rows.where(F.col("l_shipdate") < edge), rows.where(F.col("l_shipdate") >= edge)


def _delta_sql(c):
    return ", ".join(f"round((SELECT {f}({c}) FROM b) - (SELECT {f}({c}) FROM a), 3) AS delta_{n}" for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_samp"), ("median", "median")))


@query(_SPLIT + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_delta_sql(c)}" for c in NUMBERS))
def stats_delta(spark, d):
    return reports.stats_delta(*_two(spark, d), NUMBERS).withColumns(_r(*(f"delta_{s}" for s in _S), digits=3))


def _ks_sql(c):
    return f"(SELECT round(max(abs(cn / n_a - cm / n_b)), 6) FROM (SELECT {c}, CAST(sum(sum(one)) OVER (ORDER BY {c}) AS DOUBLE) AS cn, CAST(sum(sum(1 - one)) OVER (ORDER BY {c}) AS DOUBLE) AS cm FROM (SELECT {c}, 1 AS one FROM a UNION ALL SELECT {c}, 0 FROM b) GROUP BY 1), (SELECT count(*) AS n_a FROM a), (SELECT count(*) AS n_b FROM b))"


@query(f"{_SPLIT} SELECT {_ks_sql('l_extendedprice')} AS ks, (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b")
def ks_two_sample(spark, d):
    return metrics.ks_two_sample(*_two(spark, d), "l_extendedprice").withColumns(_r("ks"))


@query(_SPLIT + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_delta_sql(c)}, {_ks_sql(c)} AS ks" for c in NUMBERS))
def drift(spark, d):
    return reports.drift(*_two(spark, d), NUMBERS).withColumns(_r(*(f"delta_{s}" for s in _S), digits=3) | _r("ks"))


@query(f'WITH {_LONG} SELECT "column", round(count(CASE WHEN x <> 0 THEN 1 END) / count(*), 6) AS event_rate FROM lng GROUP BY 1')
def event_rate(spark, d):
    return reports.event_rate(_read(spark, d, "lineitem"), NUMBERS).withColumns(_r("event_rate"))


@query(f"WITH {_LONG}, t AS (SELECT * FROM (VALUES ('l_quantity', 'summed'), ('l_discount', 'carried'), ('l_discount', 'binary')) v(\"column\", treatment)) SELECT \"column\", {_STATS}, any_value(treatment) AS treatment FROM lng LEFT JOIN t USING (\"column\") GROUP BY \"column\", treatment")
def column_treatments(spark, d):
    return reports.treatments(_read(spark, d, "lineitem"), NUMBERS, {"summed": ["l_quantity"], "carried": ["l_discount"], "binary": ["l_discount"]}).withColumns(_r(*_S, digits=4))


@query(f"WITH {_ord()}, x AS (SELECT period, o_totalprice AS x FROM ord) SELECT period, 'o_totalprice' AS \"column\", {_STATS} FROM x GROUP BY 1")
def per_period_stats(spark, d):
    return reports.per_period_stats(_orders(spark, d), "period", ["o_totalprice"]).withColumns(_r(*_S, digits=4))


# The tables hold 27 quarters; the query takes their number from the data.
_QUARTERS = ", ".join(f"round(max(CASE WHEN period = {k} THEN v END), 4) AS p{k}" for k in range(27))


@query(f"WITH {_ord()}, s AS (SELECT period, min(o_totalprice) AS \"min\", max(o_totalprice) AS \"max\", avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS stddev, median(o_totalprice) AS median FROM ord GROUP BY 1), t AS (UNPIVOT s ON \"min\", \"max\", mean, stddev, median INTO NAME statistic VALUE v) SELECT statistic, {_QUARTERS} FROM t GROUP BY 1")
def per_period_wide(spark, d):
    wide = reports.per_period_wide(_orders(spark, d), "period", "o_totalprice")
    return wide.select("statistic", *(F.round(F.col(k), 4).alias(f"p{k}") for k in wide.columns if k != "statistic"))


@query(f"WITH {_ord()}, s AS (SELECT period, min(o_totalprice) AS \"min\", max(o_totalprice) AS \"max\", avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS stddev, median(o_totalprice) AS median FROM ord GROUP BY 1), t AS (SELECT * FROM s UNPIVOT INCLUDE NULLS (v FOR statistic IN (\"min\", \"max\", mean, stddev, median))) SELECT period, statistic, round(v, 4) AS value FROM t")
def per_period_tall(spark, d):
    return reports.per_period_tall(_orders(spark, d), "period", "o_totalprice").withColumns(_r("value", digits=4))


@query(f"{_FULL} SELECT period, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives, round(count(*) / nullif(sum(target), 0), 6) AS rows_per_positive FROM full_ GROUP BY 1")
def target_by_period(spark, d):
    return reports.target_by_period(_dense(spark, d), "period", "target").withColumns(_r("rows_per_positive"))


_MISS = "ms AS (SELECT o_custkey, count(DISTINCT CASE WHEN imputed = 1 THEN period END) / count(DISTINCT period) AS s FROM full_ GROUP BY 1)"


@query(f"{_FULL}, {_MISS} SELECT o_custkey, round(s, 6) AS missing_share FROM ms WHERE s > 0")
def missing_share(spark, d):
    return reports.missing_share(_dense(spark, d), "o_custkey", "period", "imputed").withColumns(_r("missing_share"))


@query(f"{_FULL}, {_MISS} SELECT CAST(e AS DOUBLE) AS edge, round(avg(CASE WHEN s > 0 AND s >= e THEN 1.0 ELSE 0.0 END), 6) AS share_of_ids FROM ms, (VALUES (0.0), (0.25), (0.5), (0.75), (0.99)) v(e) GROUP BY 1")
def missing_buckets(spark, d):
    return reports.missing_buckets(_dense(spark, d), "o_custkey", "period", "imputed").withColumns(_r("share_of_ids"))


@query(f"{_FULL}, p AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS x FROM full_ WHERE target = 1 GROUP BY 1) SELECT {_STATS} FROM p")
def positives_per_id(spark, d):
    return reports.positives_per_id(_dense(spark, d), "o_custkey", "target").withColumns(_r(*_S, digits=4))


@query(f"{_FULL} SELECT period, round(count(DISTINCT CASE WHEN target = 1 THEN o_custkey END) / count(DISTINCT o_custkey), 2) AS positive_share FROM full_ GROUP BY 1")
def positive_share_by_period(spark, d):
    return reports.positive_share_by_period(_dense(spark, d), "o_custkey", "period", "target")


@query(f"{_FULL} SELECT 'orders' AS step, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_ids, CAST(NULL AS BIGINT) AS n_positive_ids FROM orders UNION ALL SELECT 'panel', count(*), count(DISTINCT o_custkey), count(DISTINCT CASE WHEN target = 1 THEN o_custkey END) FROM full_")
def funnel(spark, d):
    return reports.funnel({"orders": _read(spark, d, "orders"), "panel": _dense(spark, d)}, "o_custkey", "target")


@query("WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') SELECT (SELECT count(*) FROM a) AS train_ids, (SELECT count(*) FROM b) AS test_ids, (SELECT count(*) FROM a JOIN b USING (o_custkey)) AS both_ids")
def leakage(spark, d):
    rows = _read(spark, d, "orders")
    return reports.leakage(rows.where("o_orderdate < timestamp_ntz'1995-06-01'"), rows.where("o_orderdate >= timestamp_ntz'2001-01-01'"), "o_custkey")


_SUFFIXES = {"_lag_[0-9]+": "lag", "_(mean|std|skew|trend)_[0-9]+": "rolling", "_diff": "difference", "_sin": "cyclical", "_cos": "cyclical"}
_LINEAGE = ["n_orders", "o_totalprice", "td", *_ENRICHED]


@query(
    f"{_FULL}, num AS (SELECT * REPLACE (CAST(n_orders AS DOUBLE) AS n_orders, CAST(td AS DOUBLE) AS td), CAST(row_number() OVER {_P} AS DOUBLE) AS pos FROM full_), e AS (SELECT n_orders, o_totalprice, td, {_enriched_sql('n_orders')}, {_enriched_sql('o_totalprice')} FROM num), "
    f"u AS (SELECT name, count(*) AS n_values FROM (UNPIVOT e ON {', '.join(_LINEAGE)} INTO NAME name VALUE x) GROUP BY 1) SELECT name, regexp_replace(name, '(_lag_[0-9]+|_(mean|std|skew|trend)_[0-9]+|_diff)$', '') AS source, "
    "CASE WHEN regexp_matches(name, '_lag_[0-9]+$') THEN 'lag' WHEN regexp_matches(name, '_(mean|std|skew|trend)_[0-9]+$') THEN 'rolling' WHEN regexp_matches(name, '_diff$') THEN 'difference' ELSE 'raw' END AS transform, n_values FROM u"
)
def column_lineage(spark, d):
    """Where each column of the enriched panel comes from, with how many values it has."""
    panel = _enriched(spark, d).select(*_LINEAGE)
    counts = features.unpivot(panel.agg(*(F.count(c).alias(c) for c in panel.columns)), panel.columns, "n_values").withColumnRenamed("column", "name")
    return reports.lineage(counts, "name", _SUFFIXES).select("name", "source", "transform", "n_values")


# ---- metrics on a deterministic score ----
_SC = "sc AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, CASE WHEN event_type = 'purchase' THEN 0.2 ELSE 0 END + ((event_id * 7919) % 997) / 997.0 * 0.8 AS p FROM events)"


def _scores(spark, d):
    y = (F.col("event_type") == "purchase").cast("int")
    return _read(spark, d, "events").select("event_id", y.alias("label"), (F.when(y == 1, 0.2).otherwise(0.0) + (F.col("event_id") * 7919 % 997) / F.lit(997.0) * 0.8).alias("p"))


@query(f"WITH {_SC} SELECT label, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n FROM sc GROUP BY ALL")
def confusion(spark, d):
    return metrics.confusion(_scores(spark, d).withColumn("prediction", (F.col("p") >= 0.5).cast("int")), "label", "prediction")


@query(
    f"WITH {_SC}, c AS (SELECT count(*) FILTER (label = 1 AND p >= 0.5) AS tp, count(*) FILTER (label = 0 AND p >= 0.5) AS fp, count(*) FILTER (label = 0 AND p < 0.5) AS tn, count(*) FILTER (label = 1 AND p < 0.5) AS fn, 1 - avg((p - label) * (p - label)) AS b FROM sc) "
    "SELECT tp, fp, tn, fn, round(b, 6) AS brier_complement, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tn / (tn + fp), 6) AS true_negative_rate, round(1 - fp / (tn + fp), 6) AS false_positive_complement, round(1 - fn / (tp + fn), 6) AS false_negative_complement FROM c"
)
def confusion_metrics(spark, d):
    names = ("brier_complement", "accuracy", "precision", "recall", "f1", "true_negative_rate", "false_positive_complement", "false_negative_complement")
    return metrics.classifier_metrics(_scores(spark, d), "label", "p").withColumns(_r(*names))


@query(f"WITH {_SC}, t AS (SELECT p, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM sc GROUP BY 1), u AS (SELECT *, sum(neg) OVER (ORDER BY p) AS upto FROM t) SELECT round(sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM u")
def auc_rank(spark, d):
    return metrics.auc(_scores(spark, d), "label", "p").withColumns(_r("auc"))


_BINS = f"WITH {_SC}, n AS (SELECT count(*) AS n FROM sc), r AS (SELECT *, row_number() OVER (ORDER BY p DESC, event_id DESC) AS i FROM sc), b AS (SELECT CAST(greatest(1, ceil((i - 1) * 10 / (n - 1))) AS INTEGER) AS bin, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, min(p) AS min_p, max(p) AS max_p FROM r, n GROUP BY 1), c AS (SELECT *, CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS cum_n, CAST(sum(positives) OVER (ORDER BY bin) AS BIGINT) AS cum_positives, sum(n) OVER () AS nn, sum(positives) OVER () AS pp FROM b)"


@query(f"{_BINS} SELECT bin, n, positives, round(min_p, 6) AS min_p, round(max_p, 6) AS max_p, cum_n, cum_positives, round(positives / n, 6) AS share, round(cum_positives / pp, 6) AS gain, round((cum_positives / pp) / (cum_n / nn), 6) AS lift FROM c")
def lift_bins(spark, d):
    return metrics.lift_bins(_scores(spark, d), "label", "p", "event_id").withColumns(_r("min_p", "max_p", "share", "gain", "lift"))


@query(f"{_BINS} SELECT bin, n, positives, printf('%.1f', round(100 * positives / n, 1)) AS share, printf('%.1f', round(100 * cum_positives / pp, 1)) AS gain, printf('%.1f', round((cum_positives / pp) / (cum_n / nn), 1)) AS lift FROM c")
def lift_table(spark, d):
    return metrics.lift_table(_scores(spark, d), "label", "p", "event_id")


@query(f"{_BINS} SELECT round(((sum(round(cum_positives / pp * 100)) - max(CASE WHEN bin = 10 THEN round(cum_positives / pp * 100) END) / 2) / 1000.0) / (1 - sum(positives) / sum(n)), 6) AS lift_statistic FROM c")
def lift_statistic(spark, d):
    return metrics.lift_statistic(_scores(spark, d), "label", "p", "event_id").withColumns(_r("lift_statistic"))


@query(f"WITH {_SC} SELECT CAST(least(floor(p * 30) + 1, 30) AS INTEGER) AS bin, count(*) AS n FROM sc WHERE p BETWEEN 0 AND 1 GROUP BY 1")
def score_histogram(spark, d):
    return metrics.histogram(_scores(spark, d), "p", 0.0, 1.0, 30)


_MD5 = "CAST('0x' || substr(md5('7|' || {}), 1, 15) AS BIGINT)"


@query(
    f"WITH t AS (SELECT o_orderkey, o_orderpriority = '1-URGENT' AS y, {_MD5.format('o_orderkey')} AS h FROM orders), c AS (SELECT count(*) FILTER (y) AS p, count(*) AS n FROM t), r AS (SELECT *, row_number() OVER (ORDER BY h, o_orderkey) AS i FROM t WHERE NOT y) "
    "SELECT o_orderkey, 1 AS target FROM t WHERE y UNION ALL SELECT o_orderkey, 0 FROM r, c WHERE i <= least(n - p, floor(p * 0.7::DOUBLE / (1 - 0.7::DOUBLE)))"
)
def downsample_rows(spark, d):
    rows = _read(spark, d, "orders").withColumn("target", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return splits.downsample(rows, "target", ["o_orderkey"], 0.7, digest=True).select("o_orderkey", "target")


@query(
    f"WITH p AS (SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS target FROM orders GROUP BY 1), n AS (SELECT floor(0.2::DOUBLE * count(*) FILTER (target = 0) / (1 - 0.2::DOUBLE)) AS k FROM p), r AS (SELECT *, row_number() OVER (ORDER BY {_MD5.format('o_custkey')}, o_custkey) AS i FROM p WHERE target = 1) "
    "SELECT o_custkey, target FROM p WHERE target = 0 UNION ALL SELECT o_custkey, target FROM r, n WHERE i <= k"
)
def base_rate_rows(spark, d):
    rows = _read(spark, d, "orders").groupBy("o_custkey").agg(F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("target"))
    return splits.restore_base_rate(rows, "o_custkey", "target", 0.2, digest=True)


# ---- scoring path, groups, cohorts, whole reports ----
_FILL = densify.Filling(zeros=("n_orders",), carried=("o_totalprice", "o_orderstatus"), since=("td",), period_days=91)


@query(
    f"WITH {_ord()}, {_PAN}, a AS (SELECT o_custkey, min(period) AS p0, arg_min(o_totalprice, period) AS price, arg_min(o_orderstatus, period) AS status, arg_min(n_orders, period) AS n FROM pan WHERE period >= 1 GROUP BY 1), "
    "k AS (SELECT *, unnest(range(0, p0)) AS k FROM a) SELECT o_custkey, CAST(p0 - k AS INTEGER) AS period, CASE WHEN k = 0 THEN n ELSE 0 END AS n_orders, price AS o_totalprice, status AS o_orderstatus, CAST(1 + 91 * k AS INTEGER) AS td, CASE WHEN k > 0 THEN 1 ELSE 0 END AS imputed FROM k"
)
def predict_panel(spark, d):
    panel = _panel(spark, d).drop("o_orderdate").withColumn("td", F.lit(1))
    return densify.scoring_panel(panel, PANEL, _FILL, at=1).select("o_custkey", "period", "n_orders", "o_totalprice", "o_orderstatus", "td", "imputed")


_OFFSET = f"""e AS (SELECT period, max(o_orderdate) AS d FROM ord GROUP BY 1), o AS (SELECT min(period) AS o FROM e WHERE {_fd('d', '(SELECT max(o_orderdate) FROM orders)')} >= 180)"""


@query(f"WITH {_ord()}, {_OFFSET} SELECT o_orderkey, CAST(period - o AS INTEGER) AS period FROM ord, o WHERE period >= o")
def offset_applied(spark, d):
    rows = _orders(spark, d)
    last = F.lit(rows.agg(F.max("o_orderdate")).first()[0])
    offset = densify.label_offset(rows, "o_orderdate", "period", last, 180).first()[0]
    return densify.apply_offset(rows, "period", offset).select("o_orderkey", "period")


_TRAIN = "event_id % 3 = 0"


def _report_sql():
    lift = "round((list_sum(g[1:{k}]) - g[{k}] / 2) / (100.0 * {k}) / (1 - p / n), 6)"
    return f"""WITH {_SC}, t AS (SELECT p AS s, count(*) FILTER (label = 1 AND NOT {_TRAIN}) AS pos, count(*) FILTER (label = 0 AND NOT {_TRAIN}) AS neg, count(*) FILTER (label = 1 AND {_TRAIN}) AS base FROM sc WHERE NOT ({_TRAIN} AND label = 0) GROUP BY 1),
 r AS (SELECT *, sum(pos + neg) OVER w AS cn, sum(pos) OVER w AS cp, sum(neg) OVER w AS cg, sum(base) OVER w AS cb, sum(pos) OVER () AS p, sum(neg) OVER () AS ng, sum(base) OVER () AS b, sum(pos + neg) OVER () AS n FROM t WINDOW w AS (ORDER BY s DESC)),
 x AS (SELECT sum(pos) FILTER (s >= 0.5) AS tp, sum(neg) FILTER (s >= 0.5) AS fp, sum(neg) FILTER (s < 0.5) AS tn, sum(pos) FILTER (s < 0.5) AS fn, sum(pos * (ng - cg + neg / 2)) / (any_value(p) * any_value(ng)) AS auc, 1 - sum(pos * (1 - s) * (1 - s) + neg * s * s) / any_value(n) AS brier, 1 - max(abs(cp / p - cb / b)) AS ks, any_value(p) AS p, any_value(n) AS n FROM r),
 g AS (SELECT list(round(100 * q / p) ORDER BY k) AS g FROM (SELECT k, sum(pos * greatest(0, least(1, CASE WHEN pos + neg = 0 THEN 0 ELSE (1 + (k * (n - 1)) // 10 - (cn - pos - neg)) / (pos + neg) END))) AS q, any_value(p) AS p FROM r, (SELECT unnest(range(1, 11)) AS k) GROUP BY k))
 SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn, round(auc, 6) AS auc, round(brier, 6) AS brier_complement, round(ks, 6) AS ks_complement, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
 round(tn / (tn + fp), 6) AS true_negative_rate, round(1 - fp / (tn + fp), 6) AS false_positive_complement, round(1 - fn / (tp + fn), 6) AS false_negative_complement, {lift.format(k=10)} AS lift_statistic, {lift.format(k=2)} AS lift_two_bins FROM x, g"""


@query(_report_sql())
def classifier_report(spark, d):
    rows = _scores(spark, d)
    counts = {"tp", "fp", "tn", "fn"}
    out = metrics.classifier_report(rows.where(~F.expr(_TRAIN)), rows.where(_TRAIN), "label", "p")
    return out.withColumns(_r(*(c for c in out.columns if c not in counts)))


_TYPED = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], "lineitem": ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]}
_TEXTS = ("o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus", "c_name", "c_mktsegment")


def _typed_sql():
    each = [f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS k, '{'date' if c.endswith('date') else 'factor' if c in _TEXTS else 'numeric'}' AS wide FROM {t}" for t, cs in _TYPED.items() for c in cs]
    return "WITH c AS (" + " UNION ALL ".join(each) + ") SELECT \"table\", \"column\", n, n_null, CASE WHEN k <= 16 THEN CAST(k AS INTEGER) END AS n_distinct, CASE WHEN k <= 1 THEN 'constant' WHEN k = 2 THEN 'two_valued' WHEN wide = 'date' THEN 'date' WHEN k <= 16 THEN 'factor' ELSE wide END AS kind FROM c"


@query(_typed_sql())
def column_types(spark, d):
    out = [groups.column_types(_read(spark, d, t), cs).select(F.lit(t).alias("table"), "column", "n", "n_null", "n_distinct", "kind") for t, cs in _TYPED.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


_IDS = "i AS (SELECT o_custkey, min(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS category FROM orders GROUP BY 1)"
_COHORT = f"""{_IDS}, q AS (SELECT count(category) AS p, count(*) FILTER (category = '1-URGENT') AS k, count(*) FILTER (category IS NULL) AS n FROM i),
 h AS (SELECT o_custkey, row_number() OVER (ORDER BY CAST('0x' || substr(md5('7|' || o_custkey), 1, 15) AS BIGINT), o_custkey) AS r FROM i WHERE category IS NULL),
 c AS (SELECT o_custkey, category FROM i WHERE category = '1-URGENT' UNION ALL SELECT o_custkey, NULL FROM h, q WHERE r <= (n * k) // p)"""


def _cohort(spark, d):
    ids = _read(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("category"))
    return splits.category_cohort(ids, "o_custkey", "category", "1-URGENT")


@query(f"WITH {_COHORT} SELECT * FROM c")
def category_cohort(spark, d):
    return _cohort(spark, d)


@query(f"WITH {_COHORT} SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM c) THEN 'cohort' ELSE 'rest' END AS part FROM orders")
def cohort_rows(spark, d):
    inside, outside = splits.restrict(_read(spark, d, "orders"), _cohort(spark, d), "o_custkey")
    return inside.select("o_orderkey", F.lit("cohort").alias("part")).unionByName(outside.select("o_orderkey", F.lit("rest").alias("part")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE CAST('0x' || substr(md5('7|' || o_custkey), 1, 15) AS BIGINT) < 345876451382054080")
def id_share(spark, d):
    """All orders of three tenths of the customers."""
    return splits.id_share(_read(spark, d, "orders"), "o_custkey", 0.3).select("o_orderkey", "o_custkey")


@query(f"{_FULL}, p AS (SELECT o_custkey, period FROM full_ WHERE period = 3 AND o_custkey NOT IN (SELECT o_custkey FROM full_ WHERE period = 3 AND target = 1)) SELECT o_custkey, period, CASE WHEN period > 3 THEN 'train' ELSE 'validate' END AS part FROM full_ UNION ALL SELECT o_custkey, period, 'predict' FROM p")
def split_parts(spark, d):
    parts = splits.split_parts(_dense(spark, d), "o_custkey", "period", "period", 3, ref=F.col("target") == 1)
    out = [df.select("o_custkey", "period", F.lit(k).alias("part")) for k, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(f"WITH {_ord('month')} SELECT period, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date, CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 AS INTEGER) AS days FROM ord GROUP BY 1")
def period_lengths(spark, d):
    return reports.period_lengths(_orders(spark, d, "month"), "period", "o_orderdate")


@query(f"{_FULL} SELECT o_custkey, period, CASE WHEN period > 3 THEN 'train' ELSE 'predict' END AS part, CASE WHEN period > 3 THEN target END AS target FROM full_")
def imputed_union(spark, d):
    train, rest = splits.period_split(_dense(spark, d).select("o_custkey", "period", "target"), "period", 3)
    return reports.imputed_union(train, rest.drop("target")).select("o_custkey", "period", "part", "target")


@query("SELECT 'l_flat' AS \"column\" WHERE (SELECT count(*) FROM lineitem WHERE l_tax > 1) = 0 UNION ALL SELECT 'l_none'")
def zero_columns(spark, d):
    rows = _read(spark, d, "lineitem").withColumns({"l_flat": (F.col("l_tax") > 1).cast("int"), "l_none": F.lit(None).cast("double")})
    return outliers.zero_columns(rows, outliers.candidates(rows.columns, ("l_",), ("tax", "flat", "none", "discount")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_shipdate < DATE '1996-01-01' THEN 'train' ELSE 'validate' END AS part, l_discount, l_quantity, l_tax FROM lineitem")
def projected_parts(spark, d):
    rows = _read(spark, d, "lineitem").withColumn("l_flat", (F.col("l_tax") > 1).cast("int"))
    old = F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    parts = select.project({"train": rows.where(old), "validate": rows.where(~old)}, "train", lambda part: select.correlation_filter(part, ["l_discount", "l_flat", "l_quantity", "l_tax"]), keys)
    train, validate = (df.withColumn("part", F.lit(k)) for k, df in parts.items())
    return train.unionByName(validate)


# ---- fitted models: what must hold of their tables, whatever the fit ----
_Y = f"{_FULL}, m AS (SELECT o_custkey, period, lead(target) OVER (PARTITION BY o_custkey ORDER BY period DESC) AS y FROM full_), y AS (SELECT * FROM m WHERE y IS NOT NULL)"
_CV = f"{_Y}, f AS (SELECT *, (row_number() OVER (ORDER BY o_custkey, period) - 1) // ((SELECT count(*) FROM y) // 3) AS f FROM y), k AS (SELECT o_custkey, period, y, CAST(CASE WHEN f < 3 THEN f END AS INTEGER) AS fold FROM f)"


def _folds(spark, d):
    from ..operators import model

    rows, names = _modelling(spark, d)
    rows = splits.fold_assign(rows, ["o_custkey", "period"], 3)
    return model.cross_validation(rows, names, "y", ["o_custkey", "period"], 3, trees=3, depth=3)


@query(f"{_CV} SELECT o_custkey, period, y, fold FROM k WHERE fold IS NOT NULL")
def cv_membership(spark, d):
    return _folds(spark, d)[0].select("o_custkey", "period", "y", "fold")


@query(f"{_CV} SELECT i AS fold, count(*) FILTER (fold IS NULL OR fold <> i) AS n_train, count(*) FILTER (fold = i) AS n_test, count(*) FILTER (fold = i AND y = 1) AS n_positive FROM k, (SELECT unnest([0, 1, 2]) AS i) GROUP BY i")
def cv_folds(spark, d):
    return _folds(spark, d)[1].select("fold", "n_train", "n_test", "n_positive")


@query()
def cv_metrics(spark, d):
    """A row for each fold with its sizes and all figures of the classifier report."""
    return _folds(spark, d)[1]


@query(f"{_Y} SELECT o_custkey, period, 1 AS adds_up FROM y")
def attributions_add_up(spark, d):
    """Of every row, whether base and attributions add up to half the log-odds of its score."""
    from ..operators import attribution, model

    rows, names = _modelling(spark, d)
    fitted = model.fit_gbt(rows.where("period > 4"), names, "y", trees=5, depth=4)
    scored = model.score(fitted, rows, names, ["o_custkey", "period", *names])
    both = attribution.attributions(fitted, scored, names, ["o_custkey", "period", "probability"])
    odds = F.log(F.col("probability") / (1 - F.col("probability"))) / 2
    return both.select("o_custkey", "period", (F.abs(F.col("margin") - odds) < 1e-6).cast("int").alias("adds_up"))


@query()
def attribution_table(spark, d):
    """The features by how much they move the score of the newest quarters."""
    from ..operators import attribution, model

    rows, names = _modelling(spark, d)
    train, test = splits.period_split(rows, "period", 4)
    fitted = model.fit_gbt(train, names, "y", trees=5, depth=4)
    return attribution.importance_table(attribution.attributions(fitted, test, names, ["o_custkey", "period"]), names)


@query(
    "SELECT \"column\", count(*) AS n, count(DISTINCT x) AS n_distinct, min(x) AS low, max(x) AS high, round(sum(x), 2) AS total FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME \"column\" VALUE x) GROUP BY 1"
)
def shadow_columns(spark, d):
    """Shadow columns hold each value of their columns, as often."""
    rows, added = select.with_shadows(_read(spark, d, "lineitem").select(*NUMBERS), NUMBERS, 11)
    long = reports.long_form(rows, added).withColumn("column", F.expr("substring(column, 8)"))
    return long.groupBy("column").agg(F.count("x").alias("n"), F.count_distinct("x").alias("n_distinct"), F.min("x").alias("low"), F.max("x").alias("high"), F.round(F.sum("x"), 2).alias("total"))


# ---- fitted selection and models: rows only ----
def _modelling(spark, d):
    """Every quarter with every feature, and the target of the id's next quarter; its newest one has no next and no label.

    Stored, for fits, scores and searches pass over it many times and its windows cost more than a fit.
    """
    rows = _enriched(spark, d)
    names = ["n_orders", "o_totalprice", "td", *_ENRICHED]
    later = F.lead("target").over(Window.partitionBy("o_custkey").orderBy(F.desc("period")))
    rows = rows.withColumn("y", later).where("y is not null")
    return stored(rows.select("o_custkey", "period", "y", *(F.col(c).cast("double").alias(c) for c in names)), "modelling"), names


@query()
def shadow_select(spark, d):
    rows, names = _modelling(spark, d)
    return spark.createDataFrame([(c,) for c in select.shadow_select(rows, names, "y", rounds=2, trees=4)], "column string")


@query()
def boruta_select(spark, d):
    """Every feature with its hits, rounds and decision."""
    rows, names = _modelling(spark, d)
    return select.boruta(rows, names, "y", rounds=10, trees=5)


@query()
def recursive_elimination(spark, d):
    rows, names = _modelling(spark, d)
    return spark.createDataFrame([(c,) for c in select.eliminate(rows, names, "y", keep=5, trees=5)], "column string")


@query()
def gbt_scores(spark, d):
    from ..operators import model

    rows, names = _modelling(spark, d)
    train, test = splits.period_split(rows, "period", 4)
    return model.score(model.fit_gbt(train, names, "y", trees=5), test, names, ["o_custkey", "period", "y"])


@query()
def coordinate_search(spark, d):
    """The best of the default model and those of fewer or more, shallower or deeper trees."""
    from ..operators import model

    rows, names = _modelling(spark, d)
    shared = model.SharedFits(stored(splits.fold_assign(rows, ["o_custkey", "period"], 2), "folds"))

    def evaluate(p):
        got = [x for x in model.cross_validate(shared, names, "y", ["o_custkey"], 2, **p) if x is not None]
        return sum(got) / max(1, len(got))

    best, value = model.coordinate_search(evaluate, {"trees": (2, 3, 10, 20, 40), "depth": (2, 3, 4, 5)}, {"trees": 20, "depth": 4})
    shared.free()
    return spark.createDataFrame([(best["trees"], best["depth"], value)], "trees int, depth int, auc double")
