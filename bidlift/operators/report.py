"""Report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import local_text_time


def latest_names(names: DataFrame, key: str) -> DataFrame:
    """One remark per ``spotid`` or ``adid``: that of the highest spotid."""
    return names.groupBy(F.col(key).cast("bigint").alias("ad_id")).agg(
        F.max_by("remark", F.struct(F.col("spotid").cast("bigint"), "remark")).alias("remark")
    )


def trained_ids(meta: DataFrame, digits: int, exactly: bool = True) -> DataFrame:
    """Models whose id has so many digits: 5 for campaigns, 6 and more for creatives."""
    length = F.length(F.col("ad_id").cast("string"))
    return meta.where(length == digits if exactly else length >= digits)


def _figures(meta: DataFrame, state: DataFrame) -> DataFrame:
    return meta.join(state.select("ad_id", "sessions", "actives", "last_train_time"), "ad_id", "left").select(
        "ad_id",
        F.col("test_auc").alias("test_cvr"),
        F.col("actives").alias("has_active"),
        F.col("sessions").alias("session"),
        F.col("col_num").alias("cols"),
        local_text_time(F.col("last_train_time")).alias("update_time"),
    )


def report_axid(meta: DataFrame, state: DataFrame, names: DataFrame, id_map: DataFrame) -> DataFrame:
    """Every axid model beside the figures of its adid. Missing names or counters give NULL."""
    figures = _figures(meta, state)
    own = trained_ids(figures, 6, exactly=False).withColumnRenamed("ad_id", "axid")
    # The last column holds the adid model's time; its name is part of the report's format.
    parent = figures.select(
        F.col("ad_id").alias("zadid"),
        F.col("test_cvr").alias("zadid_test_cvr"),
        F.col("has_active").alias("zadid_has_active"),
        F.col("session").alias("zadid_session"),
        F.col("cols").alias("zadid_cols"),
        F.col("update_time").alias("zaxid_update_time"),
    )
    named = latest_names(names, "spotid").withColumnRenamed("ad_id", "axid")
    return (
        own.join(named, "axid", "left")
        .join(id_map.withColumnRenamed("adid", "zadid"), "axid", "left")
        .join(parent, "zadid", "left")
        .select(
            "axid", "remark", "test_cvr", "has_active", "session", "cols", "update_time",
            "zadid", "zadid_test_cvr", "zadid_has_active", "zadid_session", "zadid_cols",
            "zaxid_update_time",
        )
    )


def report_adid(meta: DataFrame, state: DataFrame, names: DataFrame) -> DataFrame:
    """Old and new campaign models, highest adid first. ``state`` has an ``era`` like ``meta``."""
    named = latest_names(names, "adid")
    parts = []
    for era in ("old", "new"):
        figures = _figures(trained_ids(meta.where(F.col("era") == era), 5), state.where(F.col("era") == era))
        parts.append(figures.withColumn("time", F.lit(era)))
    return (
        parts[0]
        .unionByName(parts[1])
        .join(named, "ad_id", "left")
        .withColumnRenamed("ad_id", "adid")
        .select("adid", "remark", "test_cvr", "has_active", "session", "cols", "update_time", "time")
        .orderBy(F.desc("adid"), "time")
    )
