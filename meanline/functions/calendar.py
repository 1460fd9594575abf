"""Calendar columns of a timestamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First (month * 100 + day) of seasons 2, 3, 4 and of the next season 1.
SEASON_STARTS = (321, 621, 923, 1221)

#: Holidays with a fixed date, as month * 100 + day.
FIXED_HOLIDAYS = (101, 704, 1111, 1225)


def _month_day(ts: Column) -> Column:
    return F.month(ts) * 100 + F.dayofmonth(ts)


def season(ts: Column) -> Column:
    """1 from 21 December, 2 from 21 March, 3 from 21 June, 4 from 23 September."""
    day = _month_day(ts)
    second, third, fourth, wrap = SEASON_STARTS
    return (
        F.when((day >= wrap) | (day < second), 1).when(day < third, 2).when(day < fourth, 3).otherwise(4)
    )


def weekday(ts: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(ts) - 1


def holiday(ts: Column, days: Sequence[int] = FIXED_HOLIDAYS) -> Column:
    return _month_day(ts).isin(*days).cast("int")


def working_day(ts: Column, days: Sequence[int] = FIXED_HOLIDAYS) -> Column:
    """1 on Monday to Friday unless it is a holiday."""
    return (weekday(ts).between(1, 5) & ~_month_day(ts).isin(*days)).cast("int")


def calendar_columns(ts: Column, base_year: int, days: Sequence[int] = FIXED_HOLIDAYS) -> list[Column]:
    """season, yr (from ``base_year``), mnth, hr, holiday, weekday, workingday."""
    return [
        season(ts).alias("season"),
        (F.year(ts) - base_year).alias("yr"),
        F.month(ts).alias("mnth"),
        F.hour(ts).alias("hr"),
        holiday(ts, days).alias("holiday"),
        weekday(ts).alias("weekday"),
        working_day(ts, days).alias("workingday"),
    ]
