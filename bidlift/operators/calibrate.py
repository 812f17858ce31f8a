"""Calibration constants per ad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discount(predicted: DataFrame, click_actives: DataFrame, fractions: DataFrame) -> DataFrame:
    """Click-actives over the weighted sum of predictions over the sample fraction.

    ``predicted`` (ad_id, weight, p) holds the training rows; ``click_actives``
    (ad_id, click_actives) counts the new range only. Ads without any get 0.
    """
    total = predicted.groupBy("ad_id").agg(F.sum(F.col("weight") * F.col("p")).alias("predicted"))
    return (
        total.join(click_actives, "ad_id", "left")
        .join(fractions.select("ad_id", "fraction"), "ad_id", "left")
        .select(
            "ad_id",
            F.coalesce(
                F.col("click_actives") / F.nullif("predicted", F.lit(0.0)) / F.coalesce("fraction", F.lit(1.0)),
                F.lit(0.0),
            ).alias("discount"),
        )
    )


def bid_average(predicted: DataFrame, bid: str = "pred_bid") -> DataFrame:
    """Mean predicted bid and row count per ad, summed as decimals."""
    total = F.sum(F.col(bid).cast("decimal(18,6)")).cast("double")
    return predicted.groupBy("ad_id").agg(
        (total / F.count(bid)).alias("bid_average"), F.count(F.lit(1)).alias("num")
    )


def bid_constant(averages: DataFrame, click_actives: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Mean bid / click-actives * rows. Without click-actives the previous value stays, else NULL."""
    out = averages.join(click_actives, "ad_id", "left").select(
        "ad_id",
        (F.col("bid_average") / F.nullif("click_actives", F.lit(0)) * F.col("num")).alias("bid_constant"),
    )
    if previous is None:
        return out
    old = previous.select("ad_id", F.col("bid_constant").alias("_old"))
    return out.join(old, "ad_id", "left").select("ad_id", F.coalesce("bid_constant", "_old").alias("bid_constant"))
