"""Month and period helpers.

Month filters are always half-open ranges on the bare column, so they reach the parquet
scan as pushed filters; wrapping the column in a function would hide it from the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F


def instant(moment: dt.datetime) -> Column:
    """Literal point in time without a zone, independent of session and machine settings."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(value: Column) -> Column:
    return F.trunc(value.cast("date"), "MM")


def month_name(value: Column) -> Column:
    """``MON-YY`` text of a date."""
    return F.upper(F.date_format(value, "MMM-yy"))


def period_month(period_name: Column) -> Column:
    """First day of a ``MON-YY`` period; NULL for names that are no month, such as ADJ-98.

    Two-digit years follow the RR rule: 00-49 lie in this century, 50-99 in the last one.
    """
    parsed = F.try_to_date(F.concat(F.lit("01-"), period_name), "dd-MMM-yy")
    return F.when(F.year(parsed) >= 2050, F.add_months(parsed, -1200)).otherwise(parsed)


def next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def day_range(column: Column, start: dt.date, end: dt.date) -> Column:
    """Inclusive day range, time of day ignored."""
    after = end + dt.timedelta(days=1)
    return (column >= F.lit(start)) & (column < F.lit(after))


def in_months(column: Column, months: Iterable[dt.date] | None) -> Column:
    """Column lies in one of the months; ``None`` means every month. Adjacent months merge."""
    if months is None:
        return column.isNotNull()
    starts = sorted({m.replace(day=1) for m in months})
    if not starts:
        return F.lit(False)
    spans: list[list[dt.date]] = []
    for start in starts:
        if spans and spans[-1][1] == start:
            spans[-1][1] = next_month(start)
        else:
            spans.append([start, next_month(start)])
    tests = [(column >= F.lit(low)) & (column < F.lit(high)) for low, high in spans]
    return reduce(or_, tests)


def in_years(column: Column, years: Iterable[int]) -> Column:
    return in_months(column, [dt.date(y, m, 1) for y in years for m in range(1, 13)])


def on_last_day(column: Column) -> Column:
    """Booked on the last day of its own month."""
    return column.cast("date") == F.last_day(column)
