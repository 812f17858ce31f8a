"""Assembling training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import date_band
from ..functions.derive import add_click_active, flatten_log
from ..schemas import BID_PATHS
from ..session import materialize
from .lookup import direct


def filter_ads(log: DataFrame, ads: DataFrame, key: str = "axid") -> DataFrame:
    """Rows of the listed ads. ``ads`` should be a written table, as it is
    counted: a list of bounded size is broadcast, so the log is not shuffled."""
    return log.join(direct(ads.select(F.col("ad_id").alias("_id"))), F.col(f"ad.{key}") == F.col("_id"), "left_semi")


def old_positives(old: DataFrame) -> DataFrame:
    return add_click_active(old.where(F.col("has_active") == 1))


def window_negatives(window: DataFrame) -> DataFrame:
    """Rows known not to be converted; NULL is not known."""
    return add_click_active(window).where(F.col("has_active") != 1)


def training_rows(
    new: DataFrame, old: DataFrame, ads: DataFrame | None, key: str = "axid", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Old conversions and all new rows of the chosen ads (None: of all ads), flat."""
    if ads is not None:
        new, old = filter_ads(new, ads, key), filter_ads(old, ads, key)
    return flatten_log(old_positives(old), keep).unionByName(flatten_log(add_click_active(new), keep))


def window_training_rows(
    window: DataFrame, old: DataFrame, ads: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Conversions of the whole old range and the window's non-converted rows of the chosen adids, flat."""
    return flatten_log(old_positives(filter_ads(old, ads, "adid")), keep).unionByName(
        flatten_log(window_negatives(filter_ads(window, ads, "adid")), keep)
    )


def band_days(band: Column) -> tuple[Column, Column]:
    """First and last day of a date band."""
    third = band % 10
    month = F.make_date((band / 1000).cast("int"), (band % 1000 / 10).cast("int"), F.lit(1))
    first = F.when(third == 0, month).when(third == 1, F.date_add(month, 9)).otherwise(F.date_add(month, 19))
    last = F.when(third == 0, F.date_add(month, 8)).when(third == 1, F.date_add(month, 18)).otherwise(F.last_day(month))
    return first, last


def kept_days(kept: DataFrame) -> tuple[DataFrame, tuple]:
    """(ad_id, date) of every ad's kept band, written, and the first and last of all days.

    The days of a band are at most twelve rows an ad; the two outer dates let a
    scan of a log skip the folders or row groups outside of them.
    """
    first, last = band_days(F.col("kept_band"))
    days = materialize(kept.select("ad_id", F.explode(F.sequence(first, last)).alias("date")), "days")
    return days, tuple(days.agg(F.min("date"), F.max("date")).first())


def kept_window_rows(log: DataFrame, old: DataFrame, kept: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each ad's own kept band that are not converted, and all its conversions, flat. ``kept``: (ad_id, kept_band)."""
    days, (first, last) = kept_days(kept)
    window = log if first is None else log.where(F.col("date").between(F.lit(first), F.lit(last)))
    mine = window.join(days.withColumnsRenamed({"ad_id": "_id", "date": "_day"}), (F.col("ad.adid") == F.col("_id")) & (F.col("date") == F.col("_day")), "left_semi")
    return flatten_log(old_positives(filter_ads(old, kept, "adid")), keep).unionByName(flatten_log(window_negatives(mine), keep))


def bid_training_rows(
    bids: DataFrame, sessions: DataFrame, ads: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Bid rows of the chosen ads and session rows of all ads, flat, with bid columns only."""
    return flatten_log(filter_ads(bids, ads, "axid"), keep, BID_PATHS).unionByName(
        flatten_log(sessions, keep, BID_PATHS)
    )


def model_rows(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Each row once per model it trains: its own axid's and its adid's, as ``ad_id``."""
    return (
        rows.withColumn("ad_id", F.explode(F.array("axid", "adid")))
        .join(models.select("ad_id"), "ad_id", "left_semi")
    )
