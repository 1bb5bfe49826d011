"""Column-level helpers (scalar functions of SURVEY section 2.8)."""

from citybeat.functions.bins import left_closed_bin, right_closed_bin
from citybeat.functions.datetime import (
    calendar_parts,
    compact_digits_to_timestamp,
    epoch_to_timestamp,
    minutes_between,
    parse_mixed_timestamp,
    valid_calendar_date,
    weekday_mon0,
)
from citybeat.functions.numeric import exact_sum, round_half_even, round_half_up, to_double
from citybeat.functions.text import (
    collapse_whitespace,
    corridor_label,
    metadata_value,
    normalize_borough,
    normalize_direction,
    quarter_from_name,
)

__all__ = [
    "calendar_parts", "collapse_whitespace", "compact_digits_to_timestamp",
    "corridor_label", "epoch_to_timestamp", "exact_sum", "left_closed_bin", "metadata_value",
    "minutes_between", "normalize_borough", "normalize_direction", "parse_mixed_timestamp",
    "quarter_from_name", "right_closed_bin", "round_half_even", "round_half_up", "to_double",
    "valid_calendar_date", "weekday_mon0",
]
