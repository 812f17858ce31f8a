"""One-hot columns for tree leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def leaf_columns(rows: DataFrame, key: str = "ad_id", leaves: str = "leaves") -> DataFrame:
    """(key, tree, leaf, col): the leaves seen per tree, numbered from 1 over all trees of a model.

    A model has at most trees * 2^depth leaves, so its window is small.
    """
    seen = rows.select(key, F.posexplode(leaves).alias("tree", "leaf")).distinct()
    order = Window.partitionBy(key).orderBy("tree", "leaf")
    return seen.withColumn("col", F.row_number().over(order).cast("bigint"))


def leaf_onehot(rows: DataFrame, columns: DataFrame, row_keys: list[str], key: str = "ad_id", leaves: str = "leaves") -> DataFrame:
    """Column numbers of each row's leaves. A leaf not seen in training has no column."""
    carried = list(dict.fromkeys([*row_keys, key]))
    return (
        rows.select(*carried, F.posexplode(leaves).alias("tree", "leaf"))
        .join(columns, [key, "tree", "leaf"], "left")
        .groupBy(*carried)
        .agg(F.array_sort(F.collect_set("col")).alias("cols"))
    )
