"""Time expressions."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import DataError

#: Accepted forms of transaction times, first success wins.
FORMATS = ("yyyyMMdd'T'HHmmss", "yyyyMMddHHmmss", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss")


def parsed(c: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in formats)).cast("timestamp_ntz")


def minutes_between(a: Column, b: Column) -> Column:
    """b - a in minutes, with fractions."""
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(6e7)


def month_end_partitions(start: date, end: date) -> list[str]:
    """The last days of the months from start to end as yyyymmdd; that day alone where both are one."""
    if start > end:
        raise DataError("start date is after end date")
    if start == end:
        return [start.strftime("%Y%m%d")]
    out, year, month = [], start.year, start.month
    while (year, month) <= (end.year, end.month):
        out.append(date(year, month, calendar.monthrange(year, month)[1]).strftime("%Y%m%d"))
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return out


def last_month_end(today: date) -> str:
    return (today.replace(day=1) - timedelta(days=1)).strftime("%Y%m%d")


def parameter_date(value: str) -> date:
    """A date, from text with or without a time of day."""
    text = (value or "").strip()
    for form in ("%Y-%m-%d", "%Y%m%d", "%Y/%m/%d", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S"):
        try:
            return datetime.strptime(text, form).date()
        except ValueError:
            continue
    raise DataError(f"not a date: {value!r}")
