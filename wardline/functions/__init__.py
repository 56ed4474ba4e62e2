from wardline.functions.temporal import (
    epoch_micros,
    diff_seconds,
    diff_hours,
    diff_days_elapsed,
    diff_hours_boundary,
    diff_days,
    diff_years,
    add_hours,
    add_fractional_hours,
)
from wardline.functions.scalar import (
    capitalise,
    topcode,
    recode_contains,
    binary_recode,
    sigmoid,
    threshold_label,
    reversed_hour_index,
    band,
    safe_divide,
)

__all__ = [
    "epoch_micros", "diff_seconds", "diff_hours", "diff_days_elapsed",
    "diff_hours_boundary", "diff_days", "diff_years", "add_hours",
    "add_fractional_hours", "capitalise", "topcode", "recode_contains",
    "binary_recode", "sigmoid", "threshold_label", "reversed_hour_index",
    "band", "safe_divide",
]
