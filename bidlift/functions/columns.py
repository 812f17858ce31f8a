"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FEATURE_FIELDS


def click_active(has_click: str = "has_click", has_active: str = "has_active") -> Column:
    """Converted, unless the row is known to be unclicked. A NULL click counts as clicked."""
    unclicked = (F.col(has_click) == 0) & (F.col(has_active) == 1)
    return F.when(unclicked, F.lit(0)).otherwise(F.col(has_active))


def active_weight(active_bonus: int = 3, click_bonus: int = 6) -> Column:
    """How often a row's tokens count: 1, plus the bonuses of converted rows."""
    return (
        F.lit(1)
        + F.when(F.col("has_active") == 1, active_bonus).otherwise(0)
        + F.when(F.col("click_active") == 1, click_bonus).otherwise(0)
    ).cast("bigint")


def growth_exceeds(new: Column, old: Column, percent: int) -> Column:
    """``(new - old) / new > percent / 100`` in exact integers."""
    return (new - old) * 100 > new * percent


def date_band(date: Column) -> Column:
    """``yyyyMM`` and the third of the month: days 1-9, 10-19, 20-end."""
    third = F.least(F.floor(F.dayofmonth(date) / 10), F.lit(2))
    return (F.year(date) * 1000 + F.month(date) * 10 + third).cast("bigint")


def local_text_time(epoch: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch seconds as local text time. The session zone must be UTC."""
    return F.date_format(
        F.from_utc_timestamp(F.timestamp_seconds(epoch), zone), "yyyy-MM-dd HH:mm:ss"
    )


def field_name(pos: Column) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in FEATURE_FIELDS]), (pos + 1).cast("int"))


def token_text(field: Column, value: Column) -> Column:
    """Display name of a feature."""
    return F.concat_ws("_:_", field, value)


def smoothed(pos: Column, tot: Column, average: Column, prior: float) -> Column:
    """Conversion rate pulled towards the average by ``prior`` pseudo rows."""
    return (pos + average * F.lit(float(prior))) / (tot + F.lit(float(prior)))


def sample_bucket(keys: list[str], seed: int, buckets: int = 1_000_000) -> Column:
    """A stable bucket per row: the same row lands in the same bucket on every retry."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets))
