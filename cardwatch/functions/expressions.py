"""Column expressions shared by the rules and the history maintenance.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
OPEN_END = "2999-12-31 23:59:59"  # effective_to of an open history version
SUCCESS = "SUCCESS"  # oper_result of an accepted operation
REJECT = "REJECT"  # oper_result of a refused operation
TAG_OVERDUE_PASSPORT = "overdue_passport"
TAG_BLOCKED_PASSPORT = "blocked_passport"
TAG_OVERDUE_ACCOUNT = "overdue_account"
TAG_DIFF_CITY = "diff_city"
TAG_SUM_GUESSING = "sum_guessing"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_ntz(value: str | _dt.datetime | Column) -> Column:
    """A timestamp_ntz literal (or the column itself when given a Column)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value: str | _dt.date | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def open_end() -> Column:
    return ts_ntz(OPEN_END)


def full_name(last: str | Column = "last_name", first: str | Column = "first_name",
              middle: str | Column = "patronymic") -> Column:
    """``last || ' ' || first || ' ' || middle``; any NULL part gives NULL.

    ``concat`` (not ``concat_ws``) keeps SQL's NULL propagation.
    """
    return F.concat(col(last), F.lit(" "), col(first), F.lit(" "), col(middle))


def day_of(ts: str | Column) -> Column:
    """Calendar day of a timestamp.  ``to_date(ts) = DATE 'x'`` is turned by
    Catalyst into a pushed range filter on the parquet scan."""
    return F.to_date(col(ts))


def whole_units(amount: str | Column) -> Column:
    """Amount truncated toward zero, as ``cast(amount as int)`` does.

    Cast to bigint rather than int so that large amounts cannot overflow."""
    return col(amount).cast("bigint")


def gap_below(later: str | Column, earlier: str | Column, limit: _dt.timedelta) -> Column:
    """``later - earlier < limit`` computed exactly on day-time intervals
    (microsecond precision), never through floating day fractions."""
    return (col(later) - col(earlier)) < F.lit(limit)


def micros_since_day_start(ts: str | Column) -> Column:
    """Microseconds since midnight, from the wall-clock fields, so that the
    value never depends on the session time zone."""
    c = col(ts)
    whole = (F.hour(c).cast("bigint") * 3600 + F.minute(c).cast("bigint") * 60) * 1_000_000
    return whole + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
