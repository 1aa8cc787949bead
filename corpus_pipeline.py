"""A training corpus in five stages, each one of the operators in tidemark.llm.

Every stage works on all that the stage before it kept, and is written to the
cluster's shared folder and read again: a lost executor costs a reread, and no
stage recomputes another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import remove_contaminated
from tidemark.llm.near_dedup import keep_one_of_each
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality_classifier import fit_quality, held_out, keep_by_score
from tidemark.llm.quality_rules import fit_rules, keep_by_rules
from tidemark.llm.shared import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and the learned decision list."""
    return keep_by_rules(docs, fit_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7; the model learns from the labelled documents, as before any stage."""
    model = fit_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels").where(~held_out(4, 2)))
    return keep_by_score(docs, model, 0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest doc_id."""
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
#: SQL has no words for the fitted stages; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            work.drop(f"stage-{k - 1}")
    return docs
