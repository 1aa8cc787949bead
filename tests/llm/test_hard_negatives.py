import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, queries
from tidemark.llm.hard_negatives import VantageTree, mine_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    known = {}
    for i, v, label in sorted((r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[2], [math.floor(256 * x) for x in r[1]]), reverse=True):
        known[i] = ([math.floor(256 * x) for x in v], label)
    out = []
    for a in sorted(x for x in known if anchors(x)):
        va, la = known[a]
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, label) for i, (v, label) in known.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == la][:positives]:
            fits = [s for s in scored if s[2] != la and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(a, i, k, s[1], -p, -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def test_op11_equals_its_sql(spark, sf_dir):
    for d in (sf_dir, sf_dir.replace("sf0.001", "sf0.1")):
        c = duckdb.connect()
        c.sql(f"create view embeddings as select * from '{d}/embeddings.parquet'")
        want = sorted(c.sql(queries.ORACLES["op11_hard_negatives"]).fetchall())
        assert want and found(queries.op11_hard_negatives(spark, d)) == want


def vectors(n, seed, width=12):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, width))
    v = centers[rng.integers(0, 6, n)] + rng.normal(size=(n, width)) * rng.choice([0.05, 0.5, 2.0], n)[:, None]
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 3))) for i in range(n)]


def test_blocks_ties_copies_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_BLOCK", 60)
    monkeypatch.setattr(hard_negatives, "_LEAF", 8)
    monkeypatch.setattr(hard_negatives, "_CHUNK", 7)
    rows = vectors(500, 3)
    rows += [(1000 + i, rows[20][1], i % 2) for i in range(250)]  # a third of all rows are one vector
    rows += [(2000 + i, [float(x) for x in v[1][:5]], v[2]) for i, v in enumerate(rows[:40])]  # shorter
    rows += [rows[0], rows[40], (40, rows[41][1], 2), (40, rows[42][1], 0)]
    rows += [(3000, None, 1), (3020, [1.0, None], 1), (3040, [float("nan")] * 12, 1), (3060, [math.inf] + [0.0] * 11, 0), (3080, rows[3][1], None), (None, rows[3][1], 1), (3100, [], 1), (3120, [0.0] * 12, 2), (-20, rows[8][1], 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(mine_hard_negatives(df, F.col("vec_id") % 20 == 0))
    assert got == brute(rows, lambda i: i % 20 == 0) and len(got) > 500
    clash = df.selectExpr("*", "1 as id", "2 as v", "3 as block", "4 as score", "5 as anchor", "6 as square", "7 as leaf")
    assert found(mine_hard_negatives(clash, F.col("vec_id") % 20 == 0)) == got
    assert found(mine_hard_negatives(df, F.col("vec_id") < -1000)) == []
    assert found(mine_hard_negatives(df.where("false"), F.lit(True))) == []
    assert found(mine_hard_negatives(df.where("label = 1"), F.lit(True))) == []


def test_large_integers_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-(2**17), 2**17, 8)], int(i % 3)) for i in range(200)]
    got = found(mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0))
    assert got and got == brute(rows, lambda i: i % 10 == 0)


def test_bounds_hold_for_rows_inside_and_outside_the_sample():
    rng = np.random.default_rng(5)
    points = np.floor(256 * rng.normal(size=(900, 10)) * rng.choice([0.1, 1, 4], 900)[:, None])
    points[100:300] = points[7]
    top = int((points**2).sum(1).max())
    queries_ = points[::50]
    scores = queries_ @ points.T
    whole = VantageTree(points, top, 16)
    leaf = np.zeros(900, int)
    for k, rows in enumerate(whole.leaves):
        leaf[rows] = k
    upper = VantageTree(points[:300], top, 16).open_ended()
    for tree, of in ((whole, leaf), (upper, upper.route(points))):
        worst, best = tree.scores(queries_)
        assert (worst[:, of] <= scores).all() and (scores <= best[:, of]).all() and len(tree.leaves) > 4


def test_most_leaves_are_left_out_where_vectors_cluster():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(12, 10))
    points = centers[rng.integers(0, 12, 2000)] + 0.05 * rng.normal(size=(2000, 10))
    points = np.floor(256 * points / np.linalg.norm(points, axis=1, keepdims=True))
    queries_ = points[::100]
    _, best = VantageTree(points, int((points**2).sum(1).max()), 32).scores(queries_)
    tenth = np.sort(queries_ @ points.T, axis=1)[:, -10]
    assert np.mean(best < tenth[:, None]) > 0.5
