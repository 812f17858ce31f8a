"""Column expressions: everything here runs inside the JVM."""

from .columns import (
    active_weight,
    click_active,
    date_band,
    field_name,
    local_text_time,
    growth_exceeds,
    sample_bucket,
    smoothed,
    token_text,
)

__all__ = [
    "active_weight",
    "click_active",
    "date_band",
    "field_name",
    "growth_exceeds",
    "local_text_time",
    "sample_bucket",
    "smoothed",
    "token_text",
]
