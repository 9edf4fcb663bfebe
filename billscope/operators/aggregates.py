"""Aggregations beyond a plain ``groupBy``: ordered text lists, net sums, pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.operators.windows import in_sequence
from billscope.session import cut


def text_list(values_with_counts: str, sep: str) -> Column:
    """Sorted join of an array of (value, copies); NULL when the array is empty."""
    sorted_values = F.array_sort(values_with_counts)
    spread = F.flatten(
        F.transform(sorted_values, lambda v: F.array_repeat(v["value"], v["copies"].cast("int")))
    )
    return F.when(F.size(sorted_values) > 0, F.array_join(spread, sep))


def string_agg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sep: str,
    name: str,
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """Texts per key joined in sorted order, copies kept, NULL skipped; NULL when none is left.

    Equal texts are counted before the lists are built, so what a group collects is its distinct texts.
    ``sums`` = {column: new name} are added up along the way.
    """
    sums = sums or {}
    counted = df.groupBy(*keys, F.col(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.sum(c).alias(c) for c in sums]
    )
    entry = F.when(F.col("_value").isNotNull(), F.struct(F.col("_value").alias("value"), F.col("_copies").alias("copies")))
    return (
        counted.groupBy(*keys)
        .agg(F.collect_list(entry).alias("_list"), *[F.sum(c).alias(n) for c, n in sums.items()])
        .select(*keys, text_list("_list", sep).alias(name), *sums.values())
    )


def dense_ids(df: DataFrame, value: str, name: str) -> DataFrame:
    """(``value``, ``name``): the distinct non-NULL values numbered from 0 without gaps, through range partitions."""
    values = cut(df.select(value).where(F.col(value).isNotNull()).distinct(), "values")
    return in_sequence(values, [], [value], number=name).withColumn(name, F.col(name) - 1)


def count_distinct(df: DataFrame, keys: Sequence[str], number: str, name: str) -> DataFrame:
    """Exact number of distinct values of ``number`` per key; NULL is not counted.

    ``number`` holds non-negative longs, best dense ones (``dense_ids``). They become bits: a group has one bitmap of 4 KB for
    each 32,768 numbers it reaches into, which are merged on the map side; for groups that hold few values of many,
    ``countDistinct`` moves less. A hot group is exchanged as bitmaps, and
    its pieces are counted apart, so no task sees its values.
    """
    place = F.bitmap_bit_position(F.col(number) + 1)
    bits = df.groupBy(*keys, F.bitmap_bucket_number(F.col(number) + 1).alias("_piece")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    held = F.when(F.col("_piece").isNotNull(), F.bitmap_count("_bits")).otherwise(0)
    return bits.groupBy(*keys).agg(F.sum(held).alias(name))


def net_of_excluded(lines: DataFrame, excluded: DataFrame, doc: str, total: str, label: str, cost: str, name: str) -> DataFrame:
    """Document total minus the cost of its lines whose ``label`` is in ``excluded``."""
    from billscope.operators.joins import exists_in

    return (
        exists_in(lines, excluded, label).groupBy(doc, total).agg((F.col(total) - F.sum(cost)).alias(name))
    )


def pivot_by_name(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], field: str, fn: str = "sum") -> DataFrame:
    """Pivot into a declared list of columns, bound by name; values outside the list are ignored."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(getattr(F, fn)(field))


def dynamic_pivot(df: DataFrame, rows: Sequence[str], column: str, field: str, fn: str = "sum") -> DataFrame:
    """Pivot whose columns are the sorted distinct non-NULL values found in the data.

    Only the distinct values reach the driver, and no more of them than a pivot may have columns.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().take(bound + 1)]
    if len(found) > bound:
        raise ValueError(f"{column} has more than {bound} values")
    return pivot_by_name(df, rows, column, sorted(found), field, fn)


def quoted_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the sorted distinct values as ``[a],[b],…``, a ``]`` inside doubled."""
    escaped = F.replace(F.col(column), F.lit("]"), F.lit("]]"))
    values = df.select(F.concat(F.lit("["), escaped, F.lit("]")).alias("_quoted")).where(F.col(column).isNotNull()).distinct()
    return string_agg(values, [], "_quoted", ",", name)
