"""Nested log rows to flat feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BID_PATHS, FEATURE_FIELDS, MULTI_FIELDS, SESSION_PATHS, SINGLE_FIELDS
from .columns import click_active

_TIME_PATTERN = "yyyy-M-d+H:m:s"


def add_click_active(log: DataFrame) -> DataFrame:
    return log.withColumn("click_active", click_active())


def flatten_log(log: DataFrame, keep: tuple[str, ...] = (), paths: tuple[str, ...] | None = None) -> DataFrame:
    """Select nested leaves under their last path part; ``ad.paytype`` becomes ``ad_paytype``."""
    if paths is None:
        paths = SESSION_PATHS if "has_active" in log.columns else BID_PATHS
    extra = [c for c in ("click_active",) if c in log.columns]
    return log.select(
        *keep,
        *extra,
        F.col("ad.paytype").alias("ad_paytype"),
        *[F.col(p).alias(p.split(".")[-1]) for p in paths],
    )


def derive_fields(flat: DataFrame, on_error: str = "drop") -> DataFrame:
    """Time parts, major OS version, model family and the last data segment.

    Rows in which one of these cannot be derived are dropped, or, with
    ``on_error="keep"``, stay with every feature NULL.
    """
    if on_error not in ("drop", "keep"):
        raise ValueError(f"on_error must be 'drop' or 'keep', not {on_error!r}")
    time = F.try_to_timestamp("drt", F.lit(_TIME_PATTERN))
    segment = F.try_element_at("data", F.lit(-1))["segment"]
    derived = {
        "weekday": F.weekday(time).cast("string"),
        "time_zone": F.hour(time).cast("string"),
        "minute": F.minute(time).cast("string"),
        "osv": F.split("osv", "\\.")[0],
        "model": F.split("model", ",")[0],
        "data": segment["value"],
    }
    out = flat.withColumns(derived).drop("drt")
    usable = (
        F.col("weekday").isNotNull()
        & F.col("osv").isNotNull()
        & F.col("model").isNotNull()
        & F.col("data").isNotNull()
    )
    if on_error == "drop":
        return out.where(usable)
    return out.withColumns({f: F.when(usable, F.col(f)) for f in FEATURE_FIELDS})


def feature_arrays() -> Column:
    """One (pos, values) entry per feature field. Explode it, then ``values``."""
    entries = [
        F.struct(F.lit(pos).alias("pos"), F.array(F.col(name).cast("string")).alias("values"))
        for pos, name in enumerate(SINGLE_FIELDS)
    ]
    entries += [
        F.struct(
            F.lit(len(SINGLE_FIELDS) + pos).alias("pos"),
            F.col(name).cast("array<string>").alias("values"),
        )
        for pos, name in enumerate(MULTI_FIELDS)
    ]
    return F.array(*entries)
