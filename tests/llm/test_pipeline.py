import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tidemark.llm import queries  # noqa: E402
from tidemark.llm.near_dedup import keep_one_of_each  # noqa: E402

from .helpers import base_texts, documents  # noqa: E402
from .test_near_dedup import brute  # noqa: E402
from .test_tokens_packing_sharding import check_packing  # noqa: E402


def test_each_stage_and_the_whole(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    rules, score, near, clean = seen
    first = {r.doc_id: r for r in queries.op1_quality_rules(spark, sf_dir).collect()}
    assert set(rules) == {i for i, r in first.items() if r.kept}
    fourth = {r.doc_id: r for r in queries.op4_quality_classifier(spark, sf_dir).collect()}
    assert set(score) == {i for i in rules if fourth[i].predicted}
    assert set(near) == {i for i, (_, _, kept) in brute(list(score.items())).items() if kept}
    dirty = {r.doc_id for r in queries.op5_benchmark_decontamination(spark, sf_dir).collect()}
    assert set(clean) == set(near) - dirty and dirty
    last = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(last, list(clean.items()), Tokenizer.from_file(path("word_bpe_49k.json")), 2048)


def test_one_of_each_keeps_columns_and_drops_repeats(spark):
    docs = documents(spark)
    rows = keep_one_of_each(docs.unionByName(docs.where("doc_id < 9")).unionByName(docs.where("doc_id = 0").withColumn("doc_id", docs.doc_id * 0 + None)))
    assert rows.columns == docs.columns
    want = [i for i, (_, _, kept) in brute([(3 * k, t) for k, t in enumerate(base_texts())]).items() if kept]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows.collect()) == sorted([(False, i) for i in want] + [(True, 0)])


def edge_tables(spark, sf_dir, tmp_path, docs):
    """A folder of tables with these documents, and the given labels and benchmark with columns of clashing names."""
    d = f"{tmp_path}/tables"
    docs.write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("*", "'x' as text", "1 as score", "2 as kept").write.parquet(f"{d}/labels.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("*", "1 as doc_id", "2 as id", "3 as n").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_odd_documents_go_through_all_stages(spark, sf_dir, tmp_path):
    """Null, empty and very long texts, repeated rows, a row without an id, and columns whose names the operators use."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = " ".join(f"town{k % 977} river{k % 641} and hill{k % 13}" for k in range(40_000))
    odd = documents(spark, [None, "", " \n", words, words, words + " more", "short", "go " * 300], extra=False).selectExpr("doc_id + 1000000 as doc_id", "text", "lang", "source", "n_chars")
    docs = own.unionByName(odd).unionByName(own.where("doc_id % 17 = 0")).unionByName(own.limit(1).selectExpr("cast(null as long) as doc_id", "text", "lang", "source", "n_chars"))
    names = ["id", "n", "key", "label", "score", "kept", "component_id", "length", "start", "piece", "rank", "sequence_id", "n_words", "a", "b", "g"]
    docs = docs.selectExpr("*", *(f"{k} as {c}" for k, c in enumerate(names)))
    d = edge_tables(spark, sf_dir, tmp_path, docs)
    at, before = spark.read.parquet(f"{d}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, at, d)
        assert rows.columns == docs.columns, name
        kept = rows.collect()
        assert all(r[c] == k for r in kept for k, c in enumerate(names))
        ids = {r.doc_id for r in kept}
        if name == "near-duplicate removal":
            texts = {r.doc_id: r.text for r in at.where("doc_id is not null").collect()}
            want = {i for i, (_, _, keep) in brute(list(texts.items())).items() if keep}
            assert ids - {None} == want and len([r for r in kept if r.doc_id is not None]) == len(want)
        assert before is None or ids <= before
        before, at = ids, spark.createDataFrame(kept, rows.schema)
    last = corpus_pipeline.run(spark, d).where("doc_id is not null").collect()
    check_packing(last, [(r.doc_id, r.text) for r in kept if r.doc_id is not None], Tokenizer.from_file(path("word_bpe_49k.json")), 2048) if None not in before else None
    assert {r.doc_id for r in last} == before - {None}


def test_no_documents_no_rows(spark, sf_dir, tmp_path):
    d = edge_tables(spark, sf_dir, tmp_path, spark.read.parquet(f"{sf_dir}/documents.parquet").where("false"))
    assert corpus_pipeline.run(spark, d).count() == 0
