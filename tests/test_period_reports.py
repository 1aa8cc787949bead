"""The wide report covers every period of the data."""

from tidemark.operators import reports
from tidemark.plans import queries


def test_wide_report_of_every_period(spark, sf_dir):
    orders = queries._orders(spark, sf_dir)
    periods = {r[0] for r in orders.select("period").distinct().collect()}
    tall = {(r.statistic, r.period): r.value for r in queries.QUERIES["per_period_tall"](spark, sf_dir).collect()}
    assert {p for _, p in tall} == periods and len(tall) == 5 * len(periods) and len(periods) > 3
    wide = reports.per_period_wide(orders, "period", "o_totalprice")
    assert set(wide.columns) == {"statistic", *map(str, range(max(periods) + 1))}
    rows = {r.statistic: r for r in wide.collect()}
    assert all(round(rows[s][str(p)], 4) == v for (s, p), v in tall.items() if v is not None)
