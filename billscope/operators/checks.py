"""Data checks that run inside the plan they protect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.operators.joins import not_exists_in
from billscope.session import cut_counted


def require_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Fail the job on the first value outside the list; NULL passes. No pass of its own over the data."""
    value = F.col(column)
    bad = F.raise_error(F.concat(F.lit(f"{column} outside the allowed list: "), value))
    return df.withColumn(column, F.when(value.isNull() | value.isin(*allowed), value).otherwise(bad))


def unknown_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """One row: number of distinct values outside the list."""
    outside = df.where(~F.col(column).isin(*allowed)).select(column)
    return outside.agg(F.countDistinct(column).alias("n_unknown"))


def unmapped_values(df: DataFrame, column: str, dictionary: DataFrame, name: str = "unmapped") -> DataFrame:
    """The distinct values missing in the dictionary, one per row; NULL is not a value."""
    known = df.select(column).where(F.col(column).isNotNull()).distinct()
    return not_exists_in(known, dictionary, column).withColumnRenamed(column, name)


def row_count_flag(df: DataFrame) -> DataFrame:
    """One row: how many rows there are and whether there is nothing to load."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("nothing_to_load", F.when(F.col("n_rows") == 0, 1).otherwise(0))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop with a message when there is nothing to load; ``df`` is written on the way, so that its rows are computed once."""
    rows, seen = cut_counted(df, "required")
    if not seen["n"]:
        raise ValueError(message)
    return rows


def landed_summary(df: DataFrame, column: str, dictionary: Sequence[str], name: str = "landed") -> tuple[DataFrame, dict[str, object]]:
    """The written rows with what a load reports about them: their number (``n``), rows without a value in ``column``
    (``n_missing``) and rows with one outside the list (``n_outside``). One pass, which is the write.
    """
    value = F.col(column)
    return cut_counted(df, name, n_missing=F.count(F.when(value.isNull(), 1)), n_outside=F.count(F.when(~value.isin(*dictionary), 1)))
