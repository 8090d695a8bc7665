"""Epoch-microsecond arithmetic as native columns.

Buckets and dates use integer arithmetic on the epoch, so they are UTC whatever the session zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US
WEEK_US = 7 * DAY_US

# Day 0 of the epoch is a Thursday, so Monday-based weeks start three days before it.
_MONDAY_SHIFT_US = 3 * DAY_US


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_start(micros: Column | str, width: int | Column) -> Column:
    """Start of the ``width``-microsecond bucket holding ``micros`` (floor, also below zero)."""
    c = _column(micros)
    return c - F.pmod(c, F.lit(width) if isinstance(width, int) else width)


def utc_date(micros: Column | str) -> Column:
    """UTC calendar date of an epoch-microsecond column."""
    days = F.call_function("div", bucket_start(micros, DAY_US), F.lit(DAY_US))
    return F.date_from_unix_date(days.cast("int"))


def week_label(micros: Column | str) -> Column:
    """Midnight of the Sunday that ends the Monday-to-Sunday week holding ``micros``."""
    c = _column(micros)
    monday = bucket_start(c + _MONDAY_SHIFT_US, WEEK_US) - _MONDAY_SHIFT_US
    return monday + 6 * DAY_US


def readable_time(micros: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of an epoch-microsecond column, in the session zone."""
    return F.date_format(F.timestamp_micros(_column(micros)), "yyyy-MM-dd HH:mm:ss")


def as_date(value: date | str) -> date:
    """Parse a batch date once, so that a malformed one fails before any job starts."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_micros(moment: datetime) -> int:
    """Epoch microseconds of ``moment``; a naive one counts as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def date_range(name: str, as_of: date | str) -> tuple[date, date]:
    """Inclusive dates of ``today``, ``yesterday`` or ``last 7 days`` (the week before ``as_of``)."""
    today = as_date(as_of)
    days_back = {"today": (0, 0), "yesterday": (1, 1), "last 7 days": (7, 1)}
    if name not in days_back:
        raise ValueError(f"unknown date range {name!r}; use one of {sorted(days_back)}")
    first, last = days_back[name]
    return today - timedelta(days=first), today - timedelta(days=last)
