from ratewise.functions.scalars import (
    blend,
    clip_prediction,
    days_since,
    flatten_nested_map,
    guard_prediction,
    is_absent,
    is_digits,
    map_size,
    map_value_mean,
    map_value_sum,
    max_token,
    token_count,
)

__all__ = [
    "blend", "clip_prediction", "days_since", "flatten_nested_map", "guard_prediction",
    "is_absent", "is_digits", "map_size", "map_value_mean", "map_value_sum", "max_token",
    "token_count",
]
