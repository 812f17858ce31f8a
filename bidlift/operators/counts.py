"""Per-ad counters and id maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import click_active, date_band


def ad_counts(log: DataFrame, key: str) -> DataFrame:
    """Sessions, actives and click-actives per ad in one aggregation. ``key``: axid or adid."""
    return log.groupBy(F.col(f"ad.{key}").alias("ad_id")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("has_active") == 1).alias("actives"),
        F.count_if(click_active() == 1).alias("click_actives"),
    )


def by_level(log: DataFrame) -> DataFrame:
    """Counters of creatives and campaigns (``level``) in one pass over the log."""
    ids = F.explode(
        F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"ad.{k}").cast("bigint").alias("ad_id")) for k in ("axid", "adid")])
    )
    flat = log.select("has_active", click_active().alias("click_active"), ids.alias("id"))
    return flat.groupBy("id.ad_id", "id.level").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("has_active") == 1).alias("actives"),
        F.count_if(F.col("click_active") == 1).alias("click_actives"),
    )


def ranked_counts(levels: DataFrame, figure: str = "sessions") -> DataFrame:
    """One counter per ad, with its rank within the level, most first. Ads without any are left out."""
    order = Window.partitionBy("level").orderBy(F.desc("num"), "ad_id")
    return levels.where(F.col(figure) > 0).select("ad_id", F.col(figure).alias("num"), "level").withColumn(
        "rank", F.row_number().over(order).cast("bigint")
    )


def rows_per_ad(log: DataFrame, key: str, only: str | None = None) -> DataFrame:
    """Rows per ad; ``only`` keeps rows where this column is 1."""
    if only == "click_active":
        log = log.where(click_active() == 1)
    elif only:
        log = log.where(F.col(only) == 1)
    return log.groupBy(F.col(f"ad.{key}").alias("ad_id")).agg(F.count(F.lit(1)).alias("num"))


def id_pairs(log: DataFrame) -> DataFrame:
    """Distinct (axid, adid), without the placeholder adid 0."""
    return (
        log.where("ad.adid != 0")
        .select(F.col("ad.axid").alias("axid"), F.col("ad.adid").alias("adid"))
        .distinct()
    )


def axid_to_adid(pairs: DataFrame) -> DataFrame:
    """One adid per axid: the last in adid order."""
    return pairs.groupBy("axid").agg(F.max("adid").alias("adid"))


def adid_to_axids(pairs: DataFrame) -> DataFrame:
    """The sorted set of axids of every adid."""
    return pairs.groupBy("adid").agg(F.array_sort(F.collect_set("axid")).alias("axids"))


def bidprice_by_ad(bids: DataFrame) -> DataFrame:
    """Mean bid price per (adid, axid), summed as decimals so that the order of rows is no matter."""
    total = F.sum(F.col("bid.bidprice").cast("decimal(18,4)")).cast("double")
    return bids.groupBy(F.col("ad.adid").alias("adid"), F.col("ad.axid").alias("axid")).agg(
        F.round(total / F.count("bid.bidprice"), 6).alias("bidprice")
    )


def eligible_ads(counts: DataFrame, more_than: int | None = None, fixed: DataFrame | None = None) -> DataFrame:
    """Ads worth a model: more than so many actives, or those of a fixed list that have sessions."""
    if (more_than is None) == (fixed is None):
        raise ValueError("give either more_than or fixed")
    if fixed is not None:
        return counts.join(fixed.select("ad_id"), "ad_id", "left_semi").where("sessions > 0")
    return counts.where(F.col("actives") > more_than)


def counts_by_band(log: DataFrame, key: str = "adid") -> DataFrame:
    """Ad counters per date band (thirds of a month)."""
    return log.groupBy(F.col(f"ad.{key}").alias("ad_id"), date_band(F.col("date")).alias("band")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("has_active") == 1).alias("actives"),
    )


def date_bands(log: DataFrame) -> DataFrame:
    """First and last day and row count of every band, newest band first."""
    return (
        log.groupBy(date_band(F.col("date")).alias("band"))
        .agg(
            F.min("date").cast("string").alias("first_day"),
            F.max("date").cast("string").alias("last_day"),
            F.count(F.lit(1)).alias("num"),
        )
        .orderBy(F.desc("band"))
    )
