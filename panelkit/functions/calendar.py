"""Calendar expressions over month-begin dates.

Offsets are calendar offsets, not row offsets: a frame of exactly ``k`` months on
an integer month index finds the row of that month or nothing, so a gap in an
entity's history can never pull in a neighbouring month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def month_floor(date: Column | str) -> Column:
    """First day of the month, always a DATE."""
    return F.trunc(date, "month")


def month_index(month: Column | str) -> Column:
    """Months since year 0; differences are whole months."""
    return F.year(month) * 12 + F.month(month)


def months_between_whole(later: Column | str, earlier: Column | str) -> Column:
    return month_index(later) - month_index(earlier)


def window_month_end(begin: Column | str, months: int) -> Column:
    """Last day of a ``months``-long window that starts at ``begin``."""
    return F.last_day(F.add_months(begin, months - 1))


def is_whole_window(begin: str, end: str, months: int = 3) -> Column:
    """True where [begin, end] is exactly ``months`` whole calendar months."""
    return (F.dayofmonth(begin) == 1) & (F.col(end) == window_month_end(begin, months))


def at_month_offset(
    value: Column | str, months: int, keys: Sequence[str] = ("zip",), month: str = "month"
) -> Column:
    """``value`` of the same key exactly ``months`` later (negative: earlier).

    All offsets of one select share one exchange, one sort and one window
    operator. A window partition is one key, so it holds at most one row per
    calendar month once (key, month) is unique.
    """
    frame = (
        Window.partitionBy(*keys).orderBy(month_index(month)).rangeBetween(months, months)
    )
    return F.max(value).over(frame)
