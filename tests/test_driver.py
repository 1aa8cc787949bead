"""Stages that are reused where nothing before them changed, and tables read from a database."""

import dataclasses
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.model import Scorer
from tidemark.plans import driver
from tidemark.sources import io

from .test_plans import CONFIG

ALL = [s.name for s in driver.STAGES]


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_only_what_follows_a_change_runs_again(spark, log, tmp_path):
    folder = f"{tmp_path}/kept"
    first = driver.run(log, CONFIG, folder)
    assert first.made == ALL and first.last.count() == 1 and first.last.first().auc is not None
    assert driver.run(log, CONFIG, folder).made == []
    assert driver.run(log.repartition(5), CONFIG, folder).made == []  # the same rows
    changed = {"depth": ["model", "metrics"], "correlation": ["select", "model", "metrics"], "most": ALL[5:], "rolling": ALL[3:]}
    for name, made in changed.items():
        other = dataclasses.replace(CONFIG, **{name: {"depth": 2, "correlation": 0.5, "most": 0.8, "rolling": 3}[name]})
        assert driver.run(log, other, folder).made == made, name
    assert driver.run(log, CONFIG, folder).made == []  # and the first run's tables are still there
    assert driver.run(log.where("o_orderkey % 50 > 0"), CONFIG, folder, upto="label").made == ["clean", "label"]

    # A stage that broke off has no manifest: it and only what hangs on it is made again.
    at = first.folders["select"]
    os.remove(f"{at}/manifest.json")
    with open(f"{at}/table/half-written.parquet", "w") as f:
        f.write("no parquet")
    again = driver.run(log, CONFIG, folder)
    assert again.made == ["select"] and again.last.collect() == first.last.collect()
    first = driver.run(log, CONFIG, folder)

    sample = first.tables["sample"]
    assert sample.where("part = 'train'").groupBy("o_custkey").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert {r[0] for r in sample.select("fold").distinct().collect()} == {0, 1, 2, 3, None}
    scorer = Scorer.load(spark, f"{first.folders['model']}/scorer")
    rows = first.tables["select"].where("part = 'validate'")
    scores = first.tables["model"].where("part = 'validate'")
    assert sorted(scorer.score(rows, ["o_custkey", "period"]).collect()) == sorted(scores.select("o_custkey", "period", "probability", "prediction").collect())
    with pytest.raises(ValueError, match="no stage"):
        driver.run(log, CONFIG, folder, upto="nowhere")


def test_candidates_share_their_stages(log, tmp_path):
    candidates = [dataclasses.replace(CONFIG, trees=2, depth=d) for d in (1, 3)]
    best, table = driver.search(log, candidates, f"{tmp_path}/kept")
    rows = {r.candidate: r for r in table.collect()}
    assert rows[0].made == ",".join(ALL) and rows[1].made == "model,metrics"
    assert best == candidates[max(rows, key=lambda k: rows[k].auc)] and sum(r.best for r in rows.values()) == 1


def test_database_in_parts_with_pushed_filters(spark, log):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    driver_class = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = log.select("o_orderkey", F.when(F.col("o_custkey") % 7 > 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice", "o_orderpriority")
    rows.coalesce(1).write.jdbc(url, "orders_side", properties=driver_class)
    df = io.read_database(spark, url, "orders_side", "o_custkey", 4, **driver_class)
    assert df.columns == ["O_ORDERKEY", "O_CUSTKEY", "O_TOTALPRICE", "O_ORDERPRIORITY"] and df.rdd.getNumPartitions() == 4
    assert sorted(df.collect(), key=str) == sorted(rows.collect(), key=str)  # nulls of the column too
    sizes = [len(p) for p in df.rdd.glom().collect()]
    assert max(sizes) < 0.5 * sum(sizes)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    some = df.where("O_TOTALPRICE > 200000 and O_ORDERPRIORITY = '1-URGENT'").select("O_ORDERKEY")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,200000.0)" in plan and "EqualTo(o_orderpriority,1-URGENT)" in plan and "o_custkey" not in plan.split("ReadSchema")[1]
    want = log.where("o_totalprice > 200000 and o_orderpriority = '1-URGENT'")
    assert {r[0] for r in some.collect()} == {r.o_orderkey for r in want.collect()}
    outside = io.read_database(spark, url, "orders_side", "o_custkey", 3, 50, 60, **driver_class)
    assert outside.count() == log.count() and outside.rdd.getNumPartitions() == 3
    assert io.read_database(spark, url, "(select * from orders_side where o_orderkey < 0) t", "o_custkey", 4, **driver_class).count() == 0
