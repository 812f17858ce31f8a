"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, lines, packing, phrases, quality, secrets, sentences, sharding, suffixes, tokenfile, urls, whitening
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


def op4_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"))


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.deduped(table(spark, sf_dir, "documents"))


def op8_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduped(table(spark, sf_dir, "documents"))


def op13_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


_ALL = (
    op1_secret_scan, op2_pattern_packing, op3_suffix_dedup, op4_label_propagation_shards, op5_benchmark_decontamination,
    op6_token_file, op7_sentence_spans, op8_adaptive_quality, op9_url_rules, op10_jaccard_join, op11_chebyshev_whitening,
    op12_line_bitmaps, op13_phrase_fingerprints,
)
QUERIES = {f.__name__: f for f in _ALL}
