from cardwatch.functions.expressions import (
    OPEN_END,
    REJECT,
    SUCCESS,
    TAG_BLOCKED_PASSPORT,
    TAG_DIFF_CITY,
    TAG_OVERDUE_ACCOUNT,
    TAG_OVERDUE_PASSPORT,
    TAG_SUM_GUESSING,
    date_lit,
    day_of,
    full_name,
    gap_below,
    micros_since_day_start,
    open_end,
    ts_ntz,
    whole_units,
)

__all__ = [
    "OPEN_END", "REJECT", "SUCCESS", "TAG_BLOCKED_PASSPORT", "TAG_DIFF_CITY",
    "TAG_OVERDUE_ACCOUNT", "TAG_OVERDUE_PASSPORT", "TAG_SUM_GUESSING",
    "date_lit", "day_of", "full_name", "gap_below", "micros_since_day_start",
    "open_end", "ts_ntz", "whole_units",
]
