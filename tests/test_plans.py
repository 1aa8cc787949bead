import importlib
import os
import subprocess
import sys

from pyspark.sql import functions as F

from tidemark.plans import pipeline
from tidemark.roles import Roles
from tidemark.sources import io
from tidemark.streaming.time_since import time_since_stream

from .conftest import ROOT

CONFIG = pipeline.Config(Roles("o_custkey", "o_orderdate", "o_orderkey"), "o_orderpriority = '1-URGENT'", ["o_totalprice"], period="1quarter", horizon="6month", trees=3, depth=3, rolling=4)


def test_pipeline_runs_resumes_and_scores(spark, sf_dir, tmp_path):
    log = spark.read.parquet(f"{sf_dir}/orders.parquet")
    results = pipeline.run(log, CONFIG, f"{tmp_path}/stages")
    assert [r.name for r in results] == [n for n, _ in pipeline.STAGES]
    columns, rows = sorted(results[-1].columns), results[-1].table.count()
    assert rows == results[2].table.count()
    again = pipeline.run(log, CONFIG, f"{tmp_path}/stages", resume_from="enrich")
    last = again[-1].table
    assert [r.name for r in again] == ["enrich", "split"] and sorted(last.columns) == columns and last.count() == rows
    scores, metrics = pipeline.fit_and_score(last, CONFIG)
    assert scores.count() == last.where("part = 'validate'").count() and 0 <= metrics.first()["accuracy"] <= 1


def test_features_do_not_see_the_future(spark, sf_dir):
    log = spark.read.parquet(f"{sf_dir}/orders.parquet")
    edge = log.agg(F.max("o_orderdate")).first()[0]
    early = log.where(F.col("o_orderdate") < F.add_months(F.lit(edge.date()), -12))
    a, b = (pipeline.clean(x, CONFIG).select("o_orderkey", "timeline", "days_since_start", "days_since_timeline") for x in (log, early))
    assert b.subtract(a).count() == 0


def test_sources_round_trip(spark, tmp_path):
    path = f"{tmp_path}/log.tsv"
    with open(path, "w") as f:
        f.write("row\tid\twhen\tx\n0\t1\t2024-01-05 10:00:00\t9.0\n1\t2\t2024-02-05 10:00:00\t10.0\n")
    df = io.read_delimited(spark, path, "row int, id int, when timestamp, x double", "\t", "row")
    assert df.columns == ["id", "when", "x"] and df.agg(F.max("x")).first()[0] == 10.0
    io.write_panel(df.withColumn("period", F.col("id")), f"{tmp_path}/panel", "period")
    assert io.read_panel(spark, f"{tmp_path}/panel").where("period = 2").count() == 1
    io.write_report(df.select("id", "x"), f"{tmp_path}/report")
    assert spark.read.option("header", True).csv(f"{tmp_path}/report").count() == 2


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for k in range(3):  # three files, in order of time
        day = F.dayofmonth("ts")
        events.where((day > 10 * k) & ((day <= 10 * k + 10) | F.lit(k == 2))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = time_since_stream(stream, "user_id", "ts", "event_id", F.col("event_type") == "purchase")
    q = out.writeStream.format("memory").queryName("since").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.event_id: (r.timeline, r.days_since_ref) for r in spark.table("since").collect()}
    from tidemark.operators.timeline import days_since_last, mark_reference
    from tidemark.plans.queries import EVENTS

    is_ref = F.col("event_type") == "purchase"
    want = days_since_last(mark_reference(events, EVENTS, is_ref), EVENTS, {"d": is_ref})
    assert got == {r.event_id: (r.timeline, r.d) for r in want.collect()}


def test_the_rest_imports_without_the_training_data_operators(tmp_path):
    for name in ("__spark_entry__.py", "tidemark"):
        os.symlink(f"{ROOT}/{name}", f"{tmp_path}/{name}") if name.endswith("py") else None
    os.makedirs(f"{tmp_path}/tidemark")
    for name in os.listdir(f"{ROOT}/tidemark"):
        if name != "llm":
            os.symlink(f"{ROOT}/tidemark/{name}", f"{tmp_path}/tidemark/{name}")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=120, check=False).returncode == 0
    assert importlib.util.find_spec("tidemark") is not None
