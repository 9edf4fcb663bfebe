"""Semi, anti, flag and containment joins.

Key lists are reduced to distinct keys before a semi or anti join: copies of a hot key collapse on the
map side, and the join reuses the partitioning of that reduction. Big-to-big joins are left to the
optimiser, which broadcasts by size and splits skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.session import cut


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def exists_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with at least one match (EXISTS, IN)."""
    keys = _keys(on)
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def not_exists_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a match; rows with a NULL key stay (NOT EXISTS)."""
    keys = _keys(on)
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def not_in(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """SQL ``NOT IN``: a NULL in the list empties the result, an empty list keeps every row.

    Written as an equi anti join guarded by one aggregate over the list, so the list is never broadcast
    as a whole the way a null-aware anti join would.
    """
    facts = other.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(on).isNull(), 1)).alias("n_null")
    )
    empty = facts.select(F.col("n") == 0).scalar()
    no_null = facts.select(F.col("n_null") == 0).scalar()
    return not_exists_in(df, other.where(F.col(on).isNotNull()), on).where(
        empty | (no_null & F.col(on).isNotNull())
    )


def exists_from_date(
    df: DataFrame, other: DataFrame, on: str, since: str, date: str, condition: Column
) -> DataFrame:
    """Rows for which ``other`` has a row of the same key with ``date`` at or after the row's ``since``.

    Some date is late enough exactly when the latest is, so the other side shrinks to one row per key.
    """
    latest = other.where(condition).groupBy(F.col(on).alias("_key")).agg(F.max(date).alias("_latest"))
    return df.join(latest, (df[on] == latest["_key"]) & (latest["_latest"] >= df[since]), "left_semi")


def add_lookup(df: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join that keeps every row of ``df``."""
    return df.join(lookup, _keys(on), "left")


def add_presence(df: DataFrame, other: DataFrame, on: str | Sequence[str], name: str) -> DataFrame:
    """1 when ``other`` has the key, else 0; never multiplies rows."""
    keys = _keys(on)
    known = other.select(*keys).distinct().withColumn("_known", F.lit(True))
    return df.join(known, keys, "left").withColumn(name, F.when(F.col("_known"), 1).otherwise(0)).drop("_known")


def distinct_join(df: DataFrame, other: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT`` of ``df`` columns over a join: a semi join never builds the joined rows."""
    return exists_in(df, other, on).select(*columns).distinct()


GRAM_SIZES = (1, 2, 4, 8)


def contains_pairs(needles: DataFrame, haystacks: DataFrame) -> DataFrame:
    """Every (``needle``, ``haystack``) with the needle inside the haystack, as an equi join.

    ``needles`` has one column ``needle``, ``haystacks`` one column ``haystack``. A needle's grams are its substrings of the
    longest of a few lengths that fits. The texts' grams are reduced to those of needles and counted, and each needle is looked up by
    the one that the fewest texts hold: a word that stands in most texts is never the key of a longer needle, and a needle
    with a gram that no text holds is not looked up at all. What agrees there is checked with ``contains``. Empty needles are inside
    every text and are not looked up; callers guard against them.
    """
    size = F.lit(GRAM_SIZES[0])
    for n in GRAM_SIZES[1:]:
        size = F.when(F.length("needle") >= n, n).otherwise(size)
    at = F.explode(F.sequence(F.lit(1), F.length("needle") - F.col("_size") + 1)).alias("_at")
    wanted = needles.where(F.length("needle") > 0).distinct().withColumn("_size", size).select("needle", "_size", at)
    wanted = cut(wanted.select("needle", F.substring(F.col("needle"), F.col("_at"), F.col("_size")).alias("_gram")).distinct(), "grams")

    # only an id travels with the grams; the text joins back for candidates
    texts = haystacks.where(F.col("haystack").isNotNull()).distinct().withColumns(
        {"_a": F.xxhash64("haystack"), "_b": F.xxhash64(F.reverse("haystack"), F.lit(1))}
    )
    lengths = F.array_intersect(F.array(*map(F.lit, GRAM_SIZES)), wanted.agg(F.collect_set(F.length("_gram"))).scalar())
    places = texts.where("haystack != ''").select("_a", "_b", "haystack", F.explode(F.sequence(F.lit(1), F.length("haystack"))).alias("_at"))
    offered = places.select("_a", "_b", "haystack", "_at", F.explode(lengths).alias("_size")).where(F.col("_at") + F.col("_size") - 1 <= F.length("haystack"))
    offered = offered.select("_a", "_b", F.substring(F.col("haystack"), F.col("_at"), F.col("_size")).alias("_gram"))
    held = cut(offered.join(wanted.select("_gram").distinct(), "_gram").distinct(), "held")
    counts = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = wanted.join(counts, "_gram", "left").groupBy("needle").agg(
        F.min(F.coalesce("_n", F.lit(0))).alias("_n"), F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram")
    )
    candidates = held.join(rarest.where("_n > 0").select("needle", "_gram"), "_gram").select("_a", "_b", "needle")
    return candidates.join(texts, ["_a", "_b"]).where(F.col("haystack").contains(F.col("needle"))).select("needle", "haystack")
