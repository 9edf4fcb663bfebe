"""Small value rules: money, flags, defaults, clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the "nobody" user id in event logs.
NIL_GUID = "00000000-0000-0000-0000-000000000000"

MONEY = "decimal(19,4)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def money_or_zero(value: Column) -> Column:
    return F.coalesce(value.cast(MONEY), F.lit(0).cast(MONEY))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def not_below_zero(value: Column) -> Column:
    """Negative values become 0; NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def differs_or_missing(current: Column, wanted: Column) -> Column:
    """True when ``current`` is another value than ``wanted`` or is NULL; unknown when only ``wanted`` is NULL."""
    return (current != wanted) | current.isNull()
