"""Period keys worked out before a read: which files belong to a run."""

from __future__ import annotations

import datetime as dt


def days_of_week(first: dt.date, days: int = 7) -> list[dt.date]:
    return [first + dt.timedelta(days=n) for n in range(days)]


def week_file_key(day: dt.date) -> str:
    """Year and Monday week (days before the first Monday are in week 00)."""
    return f"{day.year}{day.strftime('%W')}"


def month_before(day: dt.date) -> str:
    """``yyyyMM`` of the month before; works in January and on the 31st."""
    last_of_previous = day.replace(day=1) - dt.timedelta(days=1)
    return last_of_previous.strftime("%Y%m")


def month_keys_of_week(first: dt.date) -> list[str]:
    """The one or two monthly catalogs a week needs."""
    return sorted({month_before(first), month_before(first + dt.timedelta(days=6))})
