"""The fitted queries read every quarter and every feature of the panel."""

import inspect

import pytest

from tidemark.operators import model, select
from tidemark.plans import queries
from tidemark.plans.queries import QUERIES

FITTED = ["boruta_select", "coordinate_search", "gbt_scores", "recursive_elimination", "shadow_select"]


def quarters(df):
    return {r[0] for r in df.select("period").distinct().collect()}


def test_every_quarter_and_feature_enters(spark, sf_dir):
    panel = QUERIES["enrich_panel"](spark, sf_dir)
    rows, names = queries._modelling(spark, sf_dir)
    ids = panel.select("o_custkey").distinct().count()
    assert rows.count() == panel.count() - ids and quarters(rows) == quarters(panel) - {0}
    later = {(r.o_custkey, r.period): r.target for r in panel.select("o_custkey", "period", "target").collect()}
    assert all(r.y == later[r.o_custkey, r.period - 1] for r in rows.select("o_custkey", "period", "y").collect())
    assert set(names) == set(panel.columns) - {"o_custkey", "period", "target"} and len(names) == 17


@pytest.mark.parametrize("name", FITTED)
def test_fitted_queries_use_all_of_it(spark, sf_dir, name, monkeypatch):
    panel = queries._modelling(spark, sf_dir)[0]
    names = set(QUERIES["enrich_panel"](spark, sf_dir).columns) - {"o_custkey", "period", "target"}
    fits = []

    def seen(f):
        def call(df, columns, *a, **k):
            fits.append((df, columns))
            return f(df, columns, *a, **k)

        return call

    monkeypatch.setattr(select, "importances", seen(select.importances))
    monkeypatch.setattr(model, "fit_gbt", seen(model.fit_gbt))
    out = QUERIES[name](spark, sf_dir)
    assert out.count() > 0
    if out.columns[0] == "column":
        assert {r[0] for r in out.collect()} <= names
    if name == "boruta_select":
        assert {r[0] for r in out.collect()} == names and {r.decision for r in out.collect()} <= {"confirmed", "tentative", "rejected"}
    df, columns = fits[0]
    assert {c for c in columns if not c.startswith("shadow_")} == names
    if name == "gbt_scores":
        assert quarters(df) | quarters(out) == quarters(panel)
        assert out.count() + df.count() == panel.count()
    elif name != "coordinate_search":
        assert df.count() == panel.count()
    else:  # two folds
        assert abs(2 * df.count() - panel.count()) <= 2


def test_the_search_starts_at_the_default_model_and_reaches_beyond(spark, sf_dir, monkeypatch):
    default = {k: inspect.signature(model.fit_gbt).parameters[k].default for k in ("trees", "depth")}
    tried = []

    def larger_is_better(df, columns, target, keys, folds, **p):
        tried.append(p)
        return [(p["trees"] + p["depth"]) / 100.0] * folds

    monkeypatch.setattr(model, "cross_validate", larger_is_better)
    got = queries.coordinate_search(spark, sf_dir).first()
    assert tried[0] == default and {2, 3} < {p["trees"] for p in tried} and {2, 3} < {p["depth"] for p in tried}
    assert got.trees > default["trees"] and got.depth > default["depth"]
