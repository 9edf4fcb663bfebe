"""Table changes as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.operators.joins import not_exists_in


def update_from(
    df: DataFrame,
    updates: DataFrame,
    on: str,
    assign: dict[str, str],
    guard: Callable[[dict[str, Column]], Column],
) -> DataFrame:
    """UPDATE … FROM … JOIN: set ``assign`` = {column: update column} where ``guard`` holds.

    ``guard`` receives the update columns by name. One key must offer one set of values; a key that
    offers several fails the job, as the outcome would depend on row order.
    """
    sources = list(dict.fromkeys(assign.values()))
    pack = F.struct(*sources)
    reduced = updates.groupBy(F.col(on).alias("_key")).agg(F.min(pack).alias("_new"), F.max(pack).alias("_other"))
    one = F.when(F.col("_new").eqNullSafe(F.col("_other")), F.col("_new")).otherwise(
        F.raise_error(F.concat(F.lit("ambiguous update for key "), F.col("_key").cast("string")))
    )
    reduced = reduced.select("_key", one.alias("_new"), F.lit(True).alias("_hit"))
    joined = df.join(reduced, df[on] == reduced["_key"], "left")
    applies = F.coalesce(F.col("_hit") & guard({c: F.col(f"_new.{c}") for c in sources}), F.lit(False))
    new = {column: F.when(applies, F.col(f"_new.{source}")).otherwise(df[column]) for column, source in assign.items()}
    return joined.select(*[new[c].alias(c) if c in new else df[c] for c in df.columns])


def update_where_exists(df: DataFrame, keys: DataFrame, on: str, column: str, value: Column, guard: Column) -> DataFrame:
    """Set ``column`` on rows whose key is in ``keys`` and for which ``guard`` holds."""
    known = keys.select(F.col(on).alias("_key")).distinct()
    joined = df.join(known, df[on] == known["_key"], "left")
    applies = F.coalesce(F.col("_key").isNotNull() & guard, F.lit(False))
    return joined.select(
        *[F.when(applies, value).otherwise(df[c]).alias(c) if c == column else df[c] for c in df.columns]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows for which the condition is true; unknown keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_matching(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return not_exists_in(df, keys, on)


def delete_groups(df: DataFrame, facts: DataFrame, on: str, having: Column, **totals: Column) -> DataFrame:
    """Drop rows whose key is among the groups of ``facts`` that satisfy ``having`` over ``totals``."""
    doomed = facts.groupBy(on).agg(*[agg.alias(name) for name, agg in totals.items()]).where(having)
    return df.join(doomed.select(on), on, "left_anti")


def only_new(rows: DataFrame, target: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key the target does not have yet; appending them twice is a no-op."""
    return not_exists_in(rows, target, on)


def override(base: DataFrame, replacement: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Replacement rows plus the base rows of all other keys, by column name, without duplicates."""
    return replacement.unionByName(not_exists_in(base, replacement, on)).distinct()


def outbox(rows: DataFrame, task: dict[str, Column], priority: int) -> tuple[DataFrame, DataFrame]:
    """Task header in its released state and the rows that belong to it.

    Write the rows first and the header last: the loader acts on released headers only, so a run that
    dies in between leaves nothing to act on. No rows means no header.
    """
    body = rows.select(*[value.alias(name) for name, value in task.items()], "*")
    header = (
        body.select(*task)
        .distinct()
        .withColumn("state_id", F.lit(1))
        .withColumn("priority", F.lit(priority))
    )
    return header, body
