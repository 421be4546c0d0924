"""Month arithmetic and date ranges.

Ranges are given as two dates (or ISO strings) in any order. Bounds are inclusive.
"""

from __future__ import annotations

import calendar
from datetime import date
from typing import Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = Union[date, str]
DateRange = Sequence[DateLike]


def as_date(value: DateLike) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def bounds(date_range: DateRange) -> tuple[date, date]:
    """The two ends of a range, earlier one first."""
    if isinstance(date_range, (str, date)) or len(date_range) != 2:
        raise ValueError("date_range must hold exactly two dates")
    first, second = (as_date(value) for value in date_range)
    return min(first, second), max(first, second)


def whole_months(date_range: DateRange) -> tuple[date, date]:
    """Widen a range to the first and last day of its months."""
    start, end = bounds(date_range)
    last_day = calendar.monthrange(end.year, end.month)[1]
    return start.replace(day=1), end.replace(day=last_day)


def within(column: Column, date_range: DateRange, rounded: bool = False) -> Column:
    """Inclusive range predicate, on the dates as given or widened to whole months."""
    start, end = whole_months(date_range) if rounded else bounds(date_range)
    return column.between(F.lit(start), F.lit(end))


def month_index(column: Column) -> Column:
    """Months since year 0; differences count calendar-month boundaries."""
    return F.year(column) * 12 + F.month(column) - 1


def month_start(index: Column) -> Column:
    """The first day of the month with this index."""
    return F.make_date(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))


def months_between_calendar(start: Column, end: Column) -> Column:
    """Calendar-month boundaries between two dates; NULL in, NULL out."""
    return month_index(end) - month_index(start)


def elapsed_months(start: Column, end: Column) -> Column:
    """Whole months elapsed: a month counts once its day of month is reached."""
    unfinished = (F.dayofmonth(end) < F.dayofmonth(start)).cast("int")
    return months_between_calendar(start, end) - unfinished


def elapsed_months_of(date_range: DateRange) -> int:
    """:func:`elapsed_months` for two known dates."""
    start, end = bounds(date_range)
    months = (end.year - start.year) * 12 + end.month - start.month
    return months - (1 if end.day < start.day else 0)
