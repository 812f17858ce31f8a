"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. Stages before the last
return the columns of ``documents``.

1. quality: documents that the quality rules reject go, with thresholds from
   the documents given to the stage.
2. near_duplicates: one document of each group of similar ones stays (five-word
   shingles, similarity 0.8).
3. benchmark: documents that hold a window of a benchmark item go.
4. secrets: every secret in a text becomes a mark; ``n_chars`` follows the text.
5. packing: texts are encoded and packed into sequences of 1024 ids.

Defined results: NULL texts are rejected by the first stage; a stage given no
rows returns none. A stage keeps columns beyond those of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlift.llm import decontaminate, jaccard, packing, quality, secrets
from bidlift.llm.common import fresh_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark_decontamination),
    ("secrets", secret_scan),
    ("packing", best_fit_packing),
]

# Tokenizer ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
