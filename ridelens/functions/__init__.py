"""Column expressions used by the operators (all built-in Spark functions)."""

from ridelens.functions.scalar import (  # noqa: F401
    as_col,
    bike_code,
    bike_label,
    blank_to_null_text,
    exact_ratio,
    haversine_m,
    member_flag,
    member_label,
    minutes_between,
    month_abbr,
    month_label,
    month_order,
    safe_ratio,
    seconds_between,
    segment_label,
    segment_label_raw,
    to_minutes,
    weekday_abbr,
    weekday_order,
)
