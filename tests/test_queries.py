import duckdb
import pytest

import __spark_entry__
from tidemark.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"shadow_select", "boruta_select", "recursive_elimination", "gbt_scores", "coordinate_search", "cv_metrics", "attribution_table"}


def norm(rows):
    def one(v):
        return "" if v is None else f"{v + 0.0:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    got = df.select(*(f"`{c}`" for c in columns)).collect()
    order = [want.columns.index(c) for c in columns]
    assert norm(got) == norm([[r[k] for k in order] for r in want.fetchall()])
    assert got


@pytest.mark.parametrize("name", sorted(SLOW - {"coordinate_search"}))
def test_fitted_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_and_registration(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) - SLOW == set(ORACLES)
