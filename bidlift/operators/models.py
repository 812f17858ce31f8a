"""Vectors, and the conversion and price models of all ads."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, materialize
from . import boosting, linear
from .boosting import BoostParams

# Fixed value: inverse strength of the linear part's L1 penalty.
INVERSE_L1 = 0.1

FULL = 2  # variants 0 and 1 train on one fold each, this one on all rows


def to_vector(encoded: DataFrame, width: int, idx: str = "idx") -> DataFrame:
    """Adds ``features``, the sparse vector of ones of each row.

    A sparse vector is stored as (type, size, indices, values). The columns are
    built as such and written; reading them under the vector type gives vectors
    without passing rows through Python. The written table is also what an
    iterative fit should read.
    """
    spark = encoded.sparkSession
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(width).cast("int").alias("size"),
        F.col(idx).cast("array<int>").alias("indices"),
        F.transform(idx, lambda _: F.lit(1.0)).alias("values"),
    )
    rows = encoded.withColumn("features", parts)
    path = fresh_path(spark, "vectors")
    rows.write.option("compression", "zstd").parquet(path)
    fields = [f if f.name != "features" else T.StructField("features", VectorUDT()) for f in rows.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


@dataclass
class TreeLinear:
    """Boosted trees whose leaves, one-hot beside the features, feed an L1 logistic model.

    ``trees`` is (ad_id, variant, tree, node, split, value); ``coefs`` is
    (ad_id, variant, cols, coefs, ...), the active columns of a model ascending
    with their coefficients: 0 .. width - 1 for features, then the leaves, then
    the constant. Both are written tables. ``average`` is the mean target of all
    training rows, the prediction of rows that have no model.
    """

    trees: DataFrame
    coefs: DataFrame
    widths: DataFrame
    params: BoostParams = field(default_factory=BoostParams)
    average: float = 0.5


MODEL_KEYS = ["ad_id", "variant"]


def _columns(width: Column, params: BoostParams) -> Column:
    """All active columns of a row: features, one leaf per tree, the constant."""
    nodes = 2 ** (params.depth + 1)
    leaf = F.transform(
        F.col("leaves"), lambda node, t: (width + t * nodes + node).cast("int")
    )
    constant = (width + params.trees * nodes).cast("int")
    return F.concat("idx", leaf, F.array(constant))


def _with_columns(rows: DataFrame, shapes: DataFrame, params: BoostParams) -> DataFrame:
    """Adds ``cols``, the active columns under the row's (ad_id, variant); NULL where there is no such model."""
    return (
        rows.join(shapes, MODEL_KEYS, "left")
        .withColumn("leaves", boosting.leaves("trees", params.depth))
        .withColumn("cols", _columns(F.col("width"), params))
        .drop("trees", "leaves", "width")
    )


def _shapes(trees: DataFrame, widths: DataFrame, params: BoostParams) -> DataFrame:
    return boosting.nested(trees, MODEL_KEYS, params.depth).join(widths, "ad_id")


def variant_rows(encoded: DataFrame, variants: tuple[int, ...] = (0, 1, FULL)) -> DataFrame:
    """Each row once per model it trains: its own fold's and the full one.

    ``encoded`` has (row_key, ad_id, idx, has_active, click_active, weight,
    fold). Fold models weigh every row alike, the full model by ``weight``.
    """
    mine = F.filter(
        F.array(F.col("fold").cast("int"), F.lit(FULL)), lambda v: v.isin(*variants)
    )
    return encoded.withColumn("variant", F.explode(mine)).select(
        "row_key", "ad_id", "variant", "idx", "click_active",
        F.when(F.col("has_active") == 1, 1.0).otherwise(0.0).alias("y"),
        F.when(F.col("variant") == FULL, F.col("weight")).otherwise(1).cast("double").alias("weight"),
    )


def fit_tree_linear(rows: DataFrame, widths: DataFrame, params: BoostParams = BoostParams()) -> TreeLinear:
    """Fit every (ad, variant) at once. ``rows``: a written table of ``variant_rows``.

    The linear part of a model depends on its own rows alone.
    """
    trees = boosting.fit(rows, MODEL_KEYS, params)
    shapes = materialize(_shapes(trees, widths, params), "shapes")
    with_columns = materialize(_with_columns(rows, shapes, params), "columns")
    coefs = linear.fit(with_columns, MODEL_KEYS, "cols", 1 / INVERSE_L1)
    average = rows.agg(F.sum(F.col("weight") * F.col("y")) / F.sum("weight")).first()[0]
    return TreeLinear(trees, coefs, widths, params, 0.5 if average is None else float(average))


def predict(model: TreeLinear, rows: DataFrame, carried: list[str]) -> DataFrame:
    """Conversion probability ``p`` of rows (carried, ad_id, variant, idx).

    One row a model meets the rows, and everything else happens within a row.
    Rows without a model get ``model.average``.
    """
    kept = list(dict.fromkeys([*carried, *MODEL_KEYS]))
    shapes = _shapes(model.trees, model.widths, model.params)
    packed = materialize(shapes.join(model.coefs.select(*MODEL_KEYS, F.col("cols").alias("_at"), F.col("coefs").alias("_by")), MODEL_KEYS), "packed")
    z = linear.margin(F.col("cols"), F.col("_at"), F.col("_by"))
    return _with_columns(rows, packed, model.params).select(*kept, F.coalesce(boosting.sigmoid(z), F.lit(model.average)).alias("p"))


PRICE_PARAMS = BoostParams(trees=100, base=0.5, loss="squared")


def fit_price(rows: DataFrame, params: BoostParams = PRICE_PARAMS) -> DataFrame:
    """Trees of the one global bid-price model. ``rows``: (row_key, idx, bidprice), a written table."""
    targets = rows.where(F.col("bidprice").isNotNull()).select("row_key", "idx", F.col("bidprice").alias("y"), F.lit(1.0).alias("weight"))
    return boosting.fit_one(materialize(targets, "targets"), params)


def predict_price(trees: DataFrame, rows: DataFrame, params: BoostParams = PRICE_PARAMS) -> DataFrame:
    """Adds ``pred_bid``. The model is one row of bounded size; without any tree it is the base price."""
    model = boosting.nested(trees.withColumn("_model", F.lit(0)), ["_model"], params.depth)
    return (
        rows.withColumn("_model", F.lit(0))
        .join(F.broadcast(model), "_model", "left")
        .withColumn("pred_bid", F.coalesce(boosting.margin("trees", params.depth, params.base), F.lit(float(params.base))))
        .drop("_model", "trees")
    )
