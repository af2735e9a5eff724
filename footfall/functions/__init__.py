"""Column-expression helpers; all of them compile to built-in Spark expressions."""

from footfall.functions.expressions import (
    behavior_name,
    bit_flag,
    checked_id,
    coerce_behavior,
    coerce_hour,
    day_span,
    flag,
    hour_in_range,
    hours_between,
    id_value,
    missing_to_null,
    parsed_hour,
    round_half_even,
    safe_ratio,
    slot,
    top_key,
)

__all__ = [
    "behavior_name", "bit_flag", "checked_id", "id_value", "coerce_behavior", "coerce_hour",
    "day_span", "flag", "hour_in_range", "hours_between", "missing_to_null", "parsed_hour", "round_half_even",
    "safe_ratio", "slot", "top_key",
]
