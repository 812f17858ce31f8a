"""Training the conversion models of all ads, and their records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calibrate, metrics, models, sampling
from ..operators.boosting import BoostParams
from ..session import materialize


@dataclass
class Trained:
    model: models.TreeLinear
    meta: DataFrame


def held_out(model: models.TreeLinear, folded: DataFrame) -> DataFrame:
    """Every row's probability under the model trained on the other fold."""
    other = materialize(folded.withColumn("variant", (1 - F.col("fold")).cast("int")), "held-out")
    return models.predict(model, other, ["row_key", "fold", "click_active"]).withColumnRenamed("p", "score")


def prepare(encoded: DataFrame, keys: list[str] | None = None, bucket=None, repeats: int = 5) -> DataFrame:
    """Folds and weights of encoded rows, written."""
    folded = sampling.assign_folds(sampling.training_weights(encoded, repeats), 2, keys, bucket)
    return materialize(folded, "folded")


def cross_auc(folded: DataFrame, widths: DataFrame, params: BoostParams = BoostParams()) -> DataFrame:
    """Mean AUC per ad of two models, each tested on the other's fold."""
    rows = materialize(models.variant_rows(folded, (0, 1)), "train")
    model = models.fit_tree_linear(rows, widths, params)
    return metrics.cross_auc(held_out(model, folded))


def train(
    folded: DataFrame,
    widths: DataFrame,
    click_actives: DataFrame,
    fractions: DataFrame,
    params: BoostParams = BoostParams(),
) -> Trained:
    """Fold models and full models of all ads in one fit, with AUC and discount."""
    rows = materialize(models.variant_rows(folded), "train")
    model = models.fit_tree_linear(rows, widths, params)
    auc = metrics.cross_auc(held_out(model, folded))
    full = materialize(folded.withColumn("variant", F.lit(models.FULL)), "full")
    predicted = models.predict(model, full, ["row_key", "weight"])
    discounts = calibrate.discount(predicted, click_actives, fractions)
    meta = (
        discounts.join(auc, "ad_id", "left")
        .join(widths.withColumnRenamed("width", "col_num"), "ad_id")
        .select("ad_id", "discount", "col_num", F.coalesce("test_auc", F.lit(0.5)).alias("test_auc"))
    )
    return Trained(model, materialize(meta, "trained"))
