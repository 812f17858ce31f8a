"""Samples, folds and row weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sample_bucket

BUCKETS = 1_000_000


def sample_fractions(rows: DataFrame, limit: int = 250_000, cap: int = 200_000) -> DataFrame:
    """Row count per ad, and the fraction of negatives to keep: below 1 only past ``limit``."""
    return (
        rows.groupBy("ad_id")
        .agg(F.count(F.lit(1)).alias("num"))
        .withColumn("fraction", F.when(F.col("num") > limit, cap / F.col("num")).otherwise(F.lit(1.0)))
    )


def stratified_sample(
    rows: DataFrame, fractions: DataFrame, keys: list[str] | None = None, bucket: Column | None = None, seed: int = 0
) -> DataFrame:
    """Keep conversions, keep negatives at their ad's fraction.

    Rows with a NULL label survive only where the ad is not sampled. ``bucket``
    (0 .. 999,999) overrides the hash of ``keys``.
    """
    if bucket is None:
        if not keys:
            raise ValueError("give the row's key columns, or a bucket")
        bucket = sample_bucket(keys, seed, BUCKETS)
    kept_negative = (F.col("has_active") == 0) & (bucket < F.col("fraction") * BUCKETS)
    return rows.join(fractions.select("ad_id", "fraction"), "ad_id").where(
        (F.col("fraction") >= 1.0) | (F.col("has_active") == 1) | kept_negative
    )


def no_sample(rows: DataFrame) -> DataFrame:
    """Row count per ad and the fraction 1, for rows that were not sampled."""
    return rows.groupBy("ad_id").agg(F.count(F.lit(1)).alias("num")).withColumn("fraction", F.lit(1.0))


def uniform_sample(
    rows: DataFrame, fraction: float, keys: list[str] | None = None, bucket: Column | None = None, seed: int = 0
) -> DataFrame:
    """The rows whose bucket lies below ``fraction``: the same rows in every run."""
    if bucket is None:
        if not keys:
            raise ValueError("give the row's key columns, or a bucket")
        bucket = sample_bucket(keys, seed, BUCKETS)
    return rows.where(bucket < fraction * BUCKETS)


def assign_folds(rows: DataFrame, n: int, keys: list[str] | None = None, bucket: Column | None = None, seed: int = 20) -> DataFrame:
    """Adds ``fold`` in 0 .. n-1, fixed per row."""
    if bucket is None:
        if not keys:
            raise ValueError("give the row's key columns, or a bucket")
        bucket = sample_bucket(keys, seed)
    return rows.withColumn("fold", F.pmod(bucket, F.lit(n)).cast("bigint"))


def training_weights(rows: DataFrame, repeats: int = 5) -> DataFrame:
    """Adds ``weight``: click-active rows count as if appended ``repeats`` more times."""
    return rows.withColumn(
        "weight", F.when(F.col("click_active") == 1, repeats + 1).otherwise(1).cast("bigint")
    )
