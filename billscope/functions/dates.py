"""Date expressions: week numbers, period keys, clamping month series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(day: Column, first_weekday: int = 7) -> Column:
    """Week number where 1 January is always in week 1; ``first_weekday`` is an ISO day number."""
    new_year = F.trunc(day, "year")
    lead_in = F.pmod(F.weekday(new_year) + F.lit(1 - first_weekday), F.lit(7))
    return (F.floor((F.dayofyear(day) - 1 + lead_in) / 7) + 1).cast("int")


def monday_week(day: Column) -> Column:
    """Week number with Monday weeks counted from 0: days before the first Monday are in week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def week_key(day: Column) -> Column:
    """Year and Monday week as six digits."""
    return F.concat(F.date_format(day, "yyyy"), F.lpad(monday_week(day).cast("string"), 2, "0"))


def month_key(day: Column, months: int = 0) -> Column:
    """``yyyyMM`` of the month ``months`` away."""
    return F.date_format(F.add_months(day, months), "yyyyMM")


def month_step(start: Column, step: Column) -> Column:
    """``start`` moved on by one month ``step`` times, each time from the value before: what a short month takes from
    the day stays lost, so 31 January leads to 28 February and then to 28 March.

    The day is the smallest month length passed on the way, at most the first day. Months of 31 days never bind; the first
    February does, with 29 days in a leap year until the next one; else the first month of 30 days.
    """
    month = F.month(start)
    to_february = F.when(month == 1, 1).otherwise(14 - month)
    leap = F.dayofmonth(F.last_day(F.add_months(F.trunc(start, "month"), to_february))) == 29
    to_thirty = F.when(month.isin(1, 12), 100).when(month == 7, 2).otherwise(1)  # from January and December February comes first
    longest = (
        F.when((step >= to_february) & leap & (step < to_february + 12), 29)
        .when(step >= to_february, 28)
        .when(step >= to_thirty, 30)
        .otherwise(31)
    )
    return F.date_add(F.add_months(F.trunc(start, "month"), step), F.least(F.dayofmonth(start), longest) - 1)


def month_steps(start: Column, end: Column) -> Column:
    """Array of ``start``, then month after month until the first value that is not before ``end``.

    Each step is one month on from the *previous value*; every value is computed by itself. The value in the month of
    ``end``, or the one after it, is the last.
    """
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    last = F.when(start >= end, 0).when(month_step(start, months) >= end, months).otherwise(months + 1)
    steps = F.sequence(F.lit(0), last)
    return (
        F.when(start.isNull() | end.isNull(), F.array(start))
        .when(F.dayofmonth(start) <= 28, F.transform(steps, lambda i: F.add_months(start, i)))
        .otherwise(F.transform(steps, lambda i: month_step(start, i)))
    )
