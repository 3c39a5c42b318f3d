from tallyloom.functions.cases import all_hold, case_first, case_last, contains_rules, like_rules, pattern
from tallyloom.functions.columns import (
    between_half_open, collapse_separator, correct_dates, day_text, hour_of, hour_text, hours_between, join_present,
    json_value, local_time, month_text, net_of, nth, parse_time, path_prefix, per_thousand, ratio, seconds_to_hours,
    segment, share_pct, shift, strip_zeros, to_long, week_label, weekday_flag,
)

__all__ = [
    "all_hold", "between_half_open", "case_first", "case_last", "collapse_separator", "contains_rules", "correct_dates",
    "day_text", "hour_of", "hour_text", "hours_between", "join_present", "json_value", "like_rules", "local_time",
    "month_text", "net_of", "nth", "parse_time", "path_prefix", "pattern", "per_thousand", "ratio", "seconds_to_hours",
    "segment", "share_pct", "shift", "strip_zeros", "to_long", "week_label", "weekday_flag",
]
