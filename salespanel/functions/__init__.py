from .accuracy import ACCURACY_NOTES, accuracy, accuracy_note
from .scalars import (
    DAY_FIRST_FORMATS,
    PANDAS_NA,
    clip0_fill,
    clip0_keep,
    day_label,
    is_valid_target,
    month_index,
    month_label,
    month_start,
    na_to_null,
    parse_number,
    parse_ts,
    present,
    process_number,
    round_half_even,
    segment_key,
    split_segment,
    split_segment_last,
)

__all__ = [
    "ACCURACY_NOTES",
    "DAY_FIRST_FORMATS",
    "PANDAS_NA",
    "accuracy",
    "accuracy_note",
    "clip0_fill",
    "clip0_keep",
    "day_label",
    "is_valid_target",
    "month_index",
    "month_label",
    "month_start",
    "na_to_null",
    "parse_number",
    "parse_ts",
    "present",
    "process_number",
    "round_half_even",
    "segment_key",
    "split_segment",
    "split_segment_last",
]
