"""Column expressions.  Everything here is a built-in Spark expression (no UDF)."""

from ratify.functions.lists import list_adds, list_removes, parse_list
from ratify.functions.dates import (
    duration_text,
    iso_year_week,
    minute_text,
    weekday_number,
)
from ratify.functions.classify import (
    is_true,
    maintenance_kind,
    vehicle_family,
    item_band,
    extra_review_minutes,
    extra_quote_minutes,
    extra_public_market_minutes,
    order_weight,
    daily_target,
)

__all__ = [
    "parse_list", "list_adds", "list_removes",
    "iso_year_week", "weekday_number", "minute_text", "duration_text",
    "is_true", "maintenance_kind", "vehicle_family", "item_band",
    "extra_review_minutes", "extra_quote_minutes", "extra_public_market_minutes",
    "order_weight", "daily_target",
]
