"""ROC AUC per ad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SLICES = 256


def auc(scored: DataFrame, key: str = "ad_id", label: str = "click_active", score: str = "score", slices: int = SLICES) -> DataFrame:
    """Area under the ROC curve per ad, ties counted half; 0.5 where one class is missing.

    A NULL score ties with the other NULLs below all scores, so that no row and
    no ad is lost. Scores are compared to twelve digits: sums of the same terms in another
    order differ beyond these, and should still tie.
    Equal scores of an ad are merged first. Each ad's distinct scores are then
    cut into slices of about equal size, so a hot ad is spread over ``slices``
    tasks; the running counts of a slice start from the totals of the slices below.
    """
    hit = F.when(F.col(label) == 1, 1).otherwise(0)
    merged = materialize(
        scored.groupBy(key, F.coalesce(F.round(score, 12), F.lit(float("-inf"))).alias("s"))
        .agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")),
        "auc",
    )
    cuts = [i / slices for i in range(1, slices)]
    bounds = merged.groupBy(key).agg(F.percentile_approx("s", cuts, 10_000).alias("b"))
    sliced = merged.join(bounds, key).select(
        key, "s", "pos", "neg", F.size(F.filter("b", lambda b: b < F.col("s"))).alias("slice")
    )
    sliced = materialize(sliced, "auc")
    totals = sliced.groupBy(key, "slice").agg(F.sum("pos").alias("sp"), F.sum("neg").alias("sn"))
    below = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        key, "slice", F.coalesce(F.sum("sn").over(below), F.lit(0)).alias("neg_below_slice")
    )
    inside = Window.partitionBy(key, "slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("neg_below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(
        starts, [key, "slice"]
    )
    wins = F.sum(
        F.col("pos").cast("double")
        * (F.col("neg_below_slice") + F.col("neg_below") + F.col("neg") * 0.5)
    )
    return (
        ranked.groupBy(key)
        .agg(wins.alias("w"), F.sum("pos").alias("np"), F.sum("neg").alias("nn"))
        .select(
            key,
            F.when((F.col("np") > 0) & (F.col("nn") > 0), F.col("w") / (F.col("np").cast("double") * F.col("nn")))
            .otherwise(F.lit(0.5))
            .alias("auc"),
        )
    )


def cross_auc(scored: DataFrame, key: str = "ad_id", fold: str = "fold", **kw) -> DataFrame:
    """Mean of the AUCs of the two held-out halves."""
    halves = scored.withColumn("_k", F.struct(key, fold))
    per_half = auc(halves, "_k", **kw).select(F.col(f"_k.{key}").alias(key), "auc")
    return per_half.groupBy(key).agg((F.sum("auc") / 2 + (2 - F.count("auc")) * 0.25).alias("test_auc"))
