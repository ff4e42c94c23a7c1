"""US market calendar as integer arithmetic on a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holidays on a given (month, day); on Saturday they are observed the
# Friday before, on Sunday the Monday after.
FIXED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (12, 25))
# Holidays on a weekday (0 = Monday) inside a day-of-month range.
FLOATING_HOLIDAYS = ((1, 0, 15, 21), (2, 0, 15, 21), (5, 0, 25, 31), (9, 0, 1, 7), (11, 3, 22, 28))


def _idiv(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter(day: Column) -> Column:
    """Easter Sunday of the day's year (Oudin's form, as published by the US Naval
    Observatory), as an offset from 28 March."""
    y = F.year(day)
    century = _idiv(y, 100)
    golden = y % 19
    h = (century - _idiv(century, 4) - _idiv(century * 8 + 13, 25) + golden * 19 + 15) % 30
    moon = h - F.when((h == 29) | ((h == 28) & (golden > 10)), 1).otherwise(0)
    weekday = (y + _idiv(y, 4) + moon + 2 - century + _idiv(century, 4)) % 7
    return F.date_add(F.make_date(y, F.lit(3), F.lit(28)), moon - weekday)


def is_us_holiday(day: Column) -> Column:
    wd = F.weekday(day)  # 0 = Monday
    found = day == F.date_sub(easter(day), 2)
    for month, dom in FIXED_HOLIDAYS:
        # The observed day is at most one day away, so shift it back and compare.
        for shift, wanted in ((0, wd < 5), (-1, wd == 0), (1, wd == 4)):
            actual = F.date_add(day, shift)
            found = found | (
                (F.month(actual) == month) & (F.dayofmonth(actual) == dom) & wanted
            )
    for month, weekday, first, last in FLOATING_HOLIDAYS:
        found = found | (
            (F.month(day) == month)
            & (wd == weekday)
            & F.dayofmonth(day).between(first, last)
        )
    return found


def is_trading_day(day: Column) -> Column:
    return (F.weekday(day) < 5) & ~is_us_holiday(day)
