import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import queries
from tidemark.llm.quality_classifier import STATISTICS, document_statistics, fit_discriminant, fit_quality, keep_by_score, score_quality
from tidemark.llm.quality_rules import FEATURES, Rule, fit_rules, keep_by_rules, learn_decision_list, quality_rules, text_statistics

from .helpers import base_texts, documents, words

LABELS = "doc_id long, quality int, toxic int"


def statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_op1_base_columns_over_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_quality_rules(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == {i: statistics(t) for i, t in docs.items()}
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_statistics_of_odd_texts(spark):
    extra = ["a b c a b c", "a b c x a b c a b", "a a a a", "x y z\nx y z\n \n\nx y z", "é É 😀 #|<>", "a\x0bb\x0cc\rd", "a b c"]
    texts = base_texts() + extra
    got = text_statistics(documents(spark, texts)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in sorted(got, key=lambda r: r.doc_id)] == [statistics(t) for t in texts]


def test_rules_reject_what_labels_call_bad_and_keep_the_rest(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op1_quality_rules(spark, sf_dir).collect() if r.doc_id in labels and not r.base_failed]
    good = [r for r in rows if labels[r.doc_id] == 1]
    bad = [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_the_plan_is_native_and_without_a_shuffle(spark, sf_dir, capsys):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    quality_rules(docs, labels).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert plan.count("[^\\x20\\x09-\\x0D]+, 0)") == 1  # words are cut out once


def test_decision_list_finds_planted_conjunctions():
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (4000, len(FEATURES)))
    bad = ((x[:, 2] > 0.8) & (x[:, 6] <= 0.5)) | (x[:, 4] > 0.9)
    rules = learn_decision_list(x, bad, rng.uniform(size=4000) < 0.33)
    hit = np.any([r.covers(x) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.98 and 2 <= len(rules) <= 6


def test_no_labels_no_rules(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], LABELS)
    assert fit_rules(docs, none) == []
    rows = quality_rules(docs, none).collect()
    assert len(rows) == len(base_texts()) and all(r.kept == (not r.base_failed) for r in rows)
    assert quality_rules(documents(spark, []), none).count() == 0


def test_keep_by_rules_keeps_own_columns(spark):
    docs = documents(spark).selectExpr("*", "'mine' as n_words", "7 as kept", "8 as rule").unionByName(documents(spark).selectExpr("*", "'mine' as n_words", "7 as kept", "8 as rule").where("doc_id = 0"))
    out = keep_by_rules(docs, [Rule((("symbol_share", ">", 0.5),))])
    assert out.columns == docs.columns
    keep = {3 * i for i, t in enumerate(base_texts()) for n, *_, rep in [statistics(t)] if n >= 50 and 100 * rep <= 50 * n}
    assert sorted(r.doc_id for r in out.collect()) == sorted([*keep, 0])


def test_statistics_follow_the_text_alone():
    import pyarrow as pa

    texts = base_texts()
    together = document_statistics(pa.array(texts, pa.string()))
    alone = np.vstack([document_statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and together.shape[1] == len(STATISTICS) and np.isfinite(together).all()


def test_discriminant_matches_the_closed_form():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (600, 3)), rng.normal(1.5, 0.5, (900, 3))])
    y = np.repeat([0.0, 1.0], [600, 900])
    model = fit_discriminant(x, y, pooled=0.0, ridge=0.0)
    logs = []
    for c in (0, 1):
        p = x[y == c]
        cov = np.cov(p.T)
        d = x - p.mean(axis=0)
        logs.append(np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.margin(x), logs[1] - logs[0], atol=1e-4)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_one_class_or_none(y):
    model = fit_discriminant(np.zeros((len(y), 4)), np.array(y))
    s = model.score(np.zeros((2, 4)))
    assert np.allclose(s, 0.5 if not y else s) and (len(y) == 0 or (s > 0.5).all() == (y[0] == 1))


def test_op4_is_accurate_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op4_quality_classifier(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.97


def test_quality_of_odd_rows(spark):
    docs = documents(spark)
    model = fit_quality(docs, spark.createDataFrame([(0, 1, 0), (3, 1, 0), (60, 0, 0), (51, 0, 0)], LABELS))
    assert score_quality(docs.unionByName(docs), model).count() == 2 * len(base_texts())
    assert keep_by_score(docs, model, 0.0).columns == docs.columns
    assert keep_by_score(docs, model, 0.0).count() == docs.count()
    assert score_quality(documents(spark, []), model).count() == 0
