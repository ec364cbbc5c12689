"""Column expressions built from Spark's own functions."""

from spokeline.functions.dates import (
    first_months,
    month_label,
    months_in_window,
    run_window,
    weekday_name,
)
from spokeline.functions.geo import haversine_km
from spokeline.functions.measures import pct_change, weighted_avg, weighted_avg_known
from spokeline.functions.text import (
    blank_to_null,
    fixed_decimals,
    pct_text,
    range_text,
    thousands,
    trim_ws,
)

__all__ = [
    "blank_to_null",
    "first_months",
    "fixed_decimals",
    "haversine_km",
    "month_label",
    "months_in_window",
    "pct_change",
    "pct_text",
    "range_text",
    "run_window",
    "thousands",
    "trim_ws",
    "weekday_name",
    "weighted_avg",
    "weighted_avg_known",
]
