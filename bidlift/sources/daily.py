"""Counters per day beside a partitioned log, so that a refresh counts only the days it replaced.

A day's partial counts lie in a partition of their own. Sums over days give the
counters of any range without a scan of the log, and a refresh of some days
reads just these days of the log and replaces just their partitions. A day
without rows keeps one row of zeros, so that its old counts go as well.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import click_active
from . import logs

FIGURES = ("sessions", "actives", "click_actives")


def day_counts(log: DataFrame) -> DataFrame:
    """(date, axid, adid, sessions, actives, click_actives): one aggregation for both levels."""
    ids = [F.col(f"ad.{k}").cast("bigint").alias(k) for k in ("axid", "adid")]
    return log.groupBy("date", *ids).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("has_active") == 1).alias("actives"),
        F.count_if(click_active() == 1).alias("click_actives"),
    )


def write_day_counts(spark: SparkSession, log_root: str, counts_root: str, first: dt.date, last: dt.date) -> None:
    """Count the log's days ``first`` to ``last`` anew and replace their partitions."""
    counted = day_counts(logs.read_log(spark, log_root, first, last))
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    none = F.lit(None).cast("bigint")
    zeros = days.select("date", none.alias("axid"), none.alias("adid"), *[F.lit(0).cast("bigint").alias(c) for c in FIGURES])
    (
        counted.unionByName(zeros)
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(counts_root)
    )


def refresh_day_counts(spark: SparkSession, log_root: str, counts_root: str, today: dt.date, days_back: int = 10) -> None:
    """After ``logs.refresh_partitions``: count its days anew, today and the ``days_back`` days before."""
    write_day_counts(spark, log_root, counts_root, today - dt.timedelta(days=days_back), today)


def read_day_counts(spark: SparkSession, counts_root: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return logs.read_log(spark, counts_root, first, last).where(F.col("sessions") > 0)


def by_level(days: DataFrame) -> DataFrame:
    """Counters of creatives and campaigns from partial counts."""
    ids = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(k).alias("ad_id")) for k in ("axid", "adid")]))
    return days.select(ids.alias("id"), *FIGURES).groupBy("id.ad_id", "id.level").agg(*[F.sum(c).alias(c) for c in FIGURES])
