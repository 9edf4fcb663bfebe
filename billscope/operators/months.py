"""Month series per register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.dates import month_steps


def month_rows(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per month step of each row; no self join and no shuffle."""
    return df.withColumn(name, F.explode(month_steps(F.col(start), F.col(end))))


def active_per_month(df: DataFrame, group: str, start: str, end: str, month: str = "month", count: str = "n_active") -> DataFrame:
    """How many rows are active per group and month step.

    Rows with the same group, start and end step through the same months, so they are counted before they
    are expanded: however many registers there are, a hot model expands its distinct periods only.
    """
    spans = df.groupBy(group, start, end).agg(F.count(F.lit(1)).alias("_n"))
    return month_rows(spans, start, end, month).groupBy(group, month).agg(F.sum("_n").alias(count))
