"""Weekly numeric distribution: distinct points of sale per (brick, SKU)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.dates import month_key
from billscope.functions.text import normalise
from billscope.operators.address import attribute_matches, exact_matches, register_attributes
from billscope.operators.joins import exists_in
from billscope.operators.windows import keep_latest
from billscope.session import cut
from billscope.sources.readers import first_candidate, on_days


def sold_skus(receipts: DataFrame, processed: DataFrame, week_skus: DataFrame) -> DataFrame:
    """Distinct (``period``, ``register``, ``sku_id``); the period is the month before the receipt.

    Names repeat endlessly across receipts, so they are made distinct per register and month before the
    join on the name: a product sold everywhere then counts once per register.
    """
    names = (
        receipts.where(F.col("content.calculation_type") == "Sell")
        .select("cashbox_number", month_key(F.to_date("content.timestamp"), -1).alias("period"), F.explode("content.products.name").alias("name"))
        .select("period", F.col("cashbox_number").alias("register"), F.lower("name").alias("name"))
        .distinct()
    )
    items = exists_in(processed, week_skus, "sku_id").select(F.lower("check_item").alias("name"), "sku_id").distinct()
    return names.join(items, "name").select("period", "register", "sku_id").distinct()


def register_addresses(documents: DataFrame, until: str) -> DataFrame:
    """Lower-cased address parts of the latest document per register, up to ``until`` (a text bound)."""
    latest = keep_latest(
        documents.where(F.col("cashbox_id.from_time") <= until).withColumns(
            {"register": F.col("cashbox_id.cashbox_number"), "from_time": F.col("cashbox_id.from_time")}
        ),
        ["register"],
        "from_time",
    )
    return first_candidate(latest, "address_candidates", "a").select(
        "register",
        F.col("client_id").alias("inn"),
        F.lower("a.house").alias("house"),
        normalise(F.col("a.street.name")).alias("street"),
        F.lower("a.district.name").alias("district"),
        F.lower("a.city.name").alias("city"),
        F.lower("a.region.name").alias("region"),
    )


def catalog_entries(catalog: DataFrame, bricks: DataFrame) -> DataFrame:
    """Catalog rows with the brick of the same month; addresses in lower case."""
    return catalog.join(bricks, ["entry", "period"]).select(
        "entry",
        "period",
        "brick",
        "inn",
        F.lower("full_address").alias("full_address"),
        F.lower("city").alias("city_text"),
        F.lower("district").alias("district_text"),
    )


def entry_profiles(registers: DataFrame, entries: DataFrame) -> DataFrame:
    """(``brick``, ``entry``) with everything that matches it: the attributes, their digest ``profile``.

    What matches one entry is bounded by the length of its address.
    """
    matched = attribute_matches(registers, entries, ["period", "brick"])
    keys = F.array_sort(F.collect_set(F.struct("period", "kind", "needle")))
    return matched.groupBy("brick", "entry").agg(keys.alias("keys")).withColumn("profile", F.sha2(F.to_json("keys"), 256))


def brick_distribution(
    receipts: DataFrame,
    processed: DataFrame,
    week_skus: DataFrame,
    documents: DataFrame,
    catalog: DataFrame,
    bricks: DataFrame,
    first_day: dt.date,
    days: int = 7,
) -> DataFrame:
    """``brick``, ``sku_id``, ``distribution`` = exact number of distinct catalog entries that sold the SKU.

    Entries of a brick that are matched by the same attributes sell the same SKUs, so they are counted
    once as a group and the group meets the SKUs: neither register-entry nor SKU-entry pairs of a whole
    region are ever built. Entries found by the tax-number rule are added where their group is not
    already counted.
    """
    sold = cut(sold_skus(on_days(receipts, "date", first_day, days), processed, week_skus))
    registers = cut(register_addresses(documents, first_day.isoformat()))
    entries = cut(catalog_entries(catalog, bricks))
    profiles = cut(entry_profiles(registers, entries))

    groups = profiles.groupBy("brick", "profile").agg(F.count(F.lit(1)).alias("n"), F.any_value("keys").alias("keys"))
    asked = groups.select("brick", "profile", "n", F.explode("keys").alias("k")).select("brick", "profile", "n", "k.*")
    sold_attributes = (
        sold.join(register_attributes(registers), "register").select("period", "sku_id", "kind", "needle").distinct()
    )
    hits = cut(sold_attributes.join(asked, ["period", "kind", "needle"]).select("brick", "sku_id", "profile", "n").distinct())

    by_inn = (
        sold.join(exact_matches(registers, entries, ["period", "brick"]), ["register", "period"])
        .select("brick", "sku_id", "entry")
        .distinct()
        .join(profiles.select("brick", "entry", "profile"), ["brick", "entry"], "left")
    )
    extra = by_inn.join(hits, ["brick", "sku_id", "profile"], "left_anti")
    return (
        hits.select("brick", "sku_id", "n")
        .unionByName(extra.select("brick", "sku_id", F.lit(1).cast("long").alias("n")))
        .groupBy("brick", "sku_id")
        .agg(F.sum("n").cast("int").alias("distribution"))
    )
