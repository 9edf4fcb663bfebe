"""Per-key order operators that hold up when one key owns a large share of the rows.

"First", "last" and "latest" are aggregates (they combine on the map side) rather than windows. Only
numbering and looking at the following row need a window; there, the rows lie in range partitions, written as the buckets of
a table, and a small table of totals carries the count and the first row of the next part across the borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.session import cut_buckets


def order_struct(df: DataFrame, order: Sequence[tuple[str, str]]) -> Column:
    """A struct that sorts ascending in the wanted order; NULL is the smallest value, as in T-SQL."""
    parts: list[Column] = []
    types = {field.name: field.dataType for field in df.schema.fields}
    for position, (name, direction) in enumerate(order):
        column = F.col(name)
        if direction == "asc":
            parts.append(column.alias(f"k{position}"))
            continue
        kind = types[name]
        if isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        elif not isinstance(kind, T.NumericType):
            raise ValueError(f"descending order needs a number, date or timestamp: {name}")
        parts += [F.col(name).isNull().alias(f"n{position}"), (-column).alias(f"k{position}")]
    return F.struct(*parts)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]], take: Sequence[str]
) -> DataFrame:
    """One row per key with ``take`` from the row that comes first (FIRST_VALUE plus DISTINCT).

    ``order`` must decide every tie, or the columns in ``take`` must agree within one.
    """
    first = F.min_by(F.struct(*take), order_struct(df, order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def keep_latest(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """All rows whose ``time`` is the maximum of their key; ties stay, NULL keys form one group.

    The maximum is an aggregate over two narrow columns. The join back is on key *and* time, so the
    older rows of a hot key do not meet in one task.
    """
    latest = df.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.max(time).alias("_latest"))
    match = df[time] == latest["_latest"]
    for i, key in enumerate(keys):
        match = match & df[key].eqNullSafe(latest[f"_{i}"])
    return df.join(latest, match, "left_semi")


def running_first(
    df: DataFrame, keys: Sequence[str], date: str, value: str
) -> DataFrame:
    """Earliest ``date`` per key and the ``value`` that goes with it (the smallest one on a tie).

    A running minimum over the same column it is ordered by is the group minimum on every row, so the
    window with DISTINCT is a plain aggregate.
    """
    return df.groupBy(*keys).agg(
        F.min(date).alias(date), F.min_by(value, F.struct(F.col(date), F.col(value))).alias(value)
    )


def in_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    number: str = "row_number",
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Row number (a long) within ``keys`` and, for ``following`` = {source: new name}, fields of the next row.

    ``order`` is a total order of the rows of a key. The rows are written once, in range partitions of (keys, order) that
    are the buckets of a table, so a key of any size lies in as many tasks as its share asks for and the windows read the
    buckets as they are: the rows are exchanged once. Each part is numbered by itself; a key that goes on over several parts gets
    the count and the first row of its other parts from a table of such keys, which has at most two rows per part. Spark
    samples ``df`` to find the ranges: write an expensive one first.
    """
    following = following or {}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_buckets(df.repartitionByRange(parts, *keys, *order), parts, "_part", "ranges")
    head = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *following])])
    names = [f"_h_{key}" for key in keys]
    totals = placed.groupBy(*[F.col(key).alias(name) for key, name in zip(keys, names)], F.col("_part").alias("_h_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(head).alias("_head")
    )
    of_key = Window.partitionBy(*names)
    by_part = of_key.orderBy("_h_part")
    carried = (
        totals.withColumn("_parts", F.count(F.lit(1)).over(of_key))
        .where("_parts > 1")
        .select(
            *names,
            "_h_part",
            F.coalesce(F.sum("_rows").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lead("_head").over(by_part).alias("_after"),
        )
    )
    match = placed["_part"] == carried["_h_part"]
    for key, name in zip(keys, names):
        match = match & placed[key].eqNullSafe(carried[name])
    joined = placed.join(F.broadcast(carried), match, "left")
    window = Window.partitionBy("_bucket", "_part", *keys).orderBy(*order)
    out = joined.withColumn(number, F.row_number().over(window).cast("long") + F.coalesce("_before", F.lit(0)))
    if following:
        crossing = F.when(F.col("_after").isNotNull(), F.struct(*[F.col(f"_after.{c}").alias(c) for c in following]))
        next_row = F.struct(*[F.col(c) for c in following])
        out = out.withColumn("_next", F.coalesce(F.lead(next_row).over(window), crossing))
    return out.select(*df.columns, number, *[F.col(f"_next.{source}").alias(name) for source, name in following.items()])


def row_identity(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """1..n along a total order."""
    return in_sequence(df, [], order, number=name)
