"""Registered queries of the training-data operators, over the whole tables they are meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    out = quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shared import Scratch
    from .token_files import read_token_files, write_token_files

    out = f"{Scratch(spark, 'tokens').root}/files"
    write_token_files(_table(spark, sf_dir, "documents"), out, _word_bpe(), end_id=1)
    return read_token_files(spark, out, digest=True)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import held_out
    from .toxicity import fit_toxicity, score_toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, fit_toxicity(docs, labels.where(~held_out(3, 1))))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import fit_quality, held_out, score_quality

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score_quality(docs, fit_quality(docs, labels.where(~held_out(4, 2))))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_benchmark

    return find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    placed = shard_documents(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    packed = pack_documents(_table(spark, sf_dir, "documents"), _word_bpe(), 2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import mine_hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .parity_join import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))


_ALL = (
    op1_quality_rules,
    op2_token_files,
    op3_toxicity,
    op4_quality_classifier,
    op5_benchmark_decontamination,
    op6_sharding,
    op7_best_fit_packing,
    op8_minhash_near_dedup,
    op9_html_extraction,
    op10_license_scans,
    op11_hard_negatives,
    op12_spelling_variants,
    op13_ngram_jaccard_join,
)
QUERIES = {f.__name__: f for f in _ALL}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _linked(width: int, percent: int, more: str = "") -> str:
    """Near duplicates from the definition alone: all shingles, all pairs that share one, and the closure of the links."""
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, md5(array_to_string(CASE WHEN len(ws) < {width} THEN ws ELSE ws[i:i + {width - 1}] END, ' ')) AS sh FROM w, unnest(range(1, greatest(2, len(ws) - {width - 2}))) AS r(i) WHERE len(ws) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n k ON k.doc_id = b WHERE 100 * both_ >= {percent} * (m.n + k.n - both_)),
 c AS (SELECT doc_id, doc_id AS low FROM documents UNION SELECT l.b, c.low FROM c JOIN l ON l.a = c.doc_id)
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(c.low) AS component_id{more} FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""


#: Hard negatives from the definition alone: all scores of the anchors, ranked.
_NEGATIVES = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
 p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
 n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
 SELECT * FROM n WHERE rank <= 10"""
#: The others follow from a fitted model, a tokenizer or a packing, or return CRC-32, which SQL has no words for;
#: tests/llm compares them with brute force.
ORACLES: dict[str, str] = {"op8_minhash_near_dedup": _linked(5, 75, ", d.doc_id = min(c.low) AS kept"), "op11_hard_negatives": _NEGATIVES, "op13_ngram_jaccard_join": _linked(4, 85)}
